"""Session helpers: one place for the settings every job relies on.

* ``spark.sql.session.timeZone`` is pinned to UTC so that the date parts derived
  from a publish time never depend on the machine that runs the job.
* Adaptive execution stays on (coalescing, skew-join splitting, runtime join
  strategy).  Those are Spark's defaults; we only make them explicit.
* Scratch output (checkpoints, round trips, staged versions) goes under the
  shared folder the cluster names in ``spark.checkpoint.dir``.  A folder of our
  own is chosen only when that setting is empty (local tests).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"


def build_session(master: str | None = None, app: str = "chanpulse",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with the settings the library expects."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # no Python call-site capture per column function: it costs several
        # driver<->JVM round trips per function when a plan is built, and
        # only adds the Python line to DataFrame error messages
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    pin_utc(spark)
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Date parts (publish_date, day of week, hour, month) are taken in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder.  A folder of our own is made only for a local
    master; on a cluster a missing setting is an error, since executors don't see
    the driver's disk."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not is_local_master(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="chanpulse-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def is_local_master(master: str) -> bool:
    """Driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/chanpulse/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and reread it:
    what is behind it runs once, whoever reads it, and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def run_jobs(thunks: list[Callable[[], object]], max_workers: int = 8) -> list:
    """Run independent Spark actions from driver threads so the scheduler can
    run their tasks side by side; results in order, the first failure raised
    after all have ended."""
    if len(thunks) < 2:
        return [t() for t in thunks]
    with ThreadPoolExecutor(max_workers=min(len(thunks), max_workers)) as pool:
        futures = [pool.submit(t) for t in thunks]
    return [f.result() for f in futures]
