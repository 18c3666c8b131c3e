import pytest

from chanpulse.session import checkpoint_root, run_jobs


def test_run_jobs_keeps_order_and_raises_after_all(spark):
    done = []

    def job(n):
        def run():
            done.append(n)
            return spark.range(n).count()
        return run

    assert run_jobs([job(3), job(5), job(7)]) == [3, 5, 7]

    def bad():
        raise ValueError("boom")

    done.clear()
    with pytest.raises(ValueError, match="boom"):
        run_jobs([bad, job(4)])
    assert done == [4]  # the other job still ran to the end


def test_no_machine_local_folder_on_a_cluster():
    from chanpulse.session import is_local_master
    assert is_local_master("local") and is_local_master("local[4]")
    for master in ("yarn", "spark://h:7077", "k8s://h", "local-cluster[3,2,1024]"):
        assert not is_local_master(master)

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_checkpoint_root_uses_the_session_setting(spark):
    root = checkpoint_root(spark)
    assert root
    assert spark.sparkContext.getCheckpointDir()
