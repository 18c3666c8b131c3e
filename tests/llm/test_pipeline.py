"""The pipeline: its stages in order, each one's effect, and the library without it."""

import os
import shutil
import subprocess
import sys

import pytest

import corpus_pipeline
from chanpulse.llm import neardup
from tests.llm.fixtures import empty, messy, words_of

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialise(spark, stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_stages_keep_columns_and_documents(steps):
    docs, lang, good, unique, mix, tokens = steps
    for step in (lang, good, unique, mix):
        assert step.columns == docs.columns
    n = [s.count() for s in steps]
    assert n[0] >= n[1] >= n[2] >= n[3] and n[4] == n[5] > 0
    assert n[1] >= 0.98 * n[0]


def test_clean_documents_stay_and_junk_goes(spark, steps):
    marked = spark.read.parquet(f"{SF}/labels.parquet").collect()
    kept = {r["doc_id"] for r in steps[2].collect()}
    assert all(r["doc_id"] in kept for r in marked if r["quality"] == 1)
    assert not any(r["doc_id"] in kept for r in marked if r["quality"] == 0)


def test_one_of_each_group_stays(steps):
    again = neardup.components(steps[3], neardup.SHINGLE).collect()
    assert len({r["component_id"] for r in again}) == len(again)


def test_mix_takes_as_many_words_as_there_are(steps):
    size = lambda df: sum(len(words_of(r["text"])) for r in df.collect())
    assert abs(size(steps[4]) - size(steps[3])) <= 20
    most = {r["doc_id"]: len(words_of(r["text"])) for r in steps[3].collect()}
    taken = {}
    for r in steps[4].collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(words_of(r["text"]))
    assert all(n <= 3 * most[k] for k, n in taken.items())


def test_tokens_decode_to_the_texts(steps):
    from chanpulse.llm import bpe
    e = bpe.encoder(bpe.default_path())
    texts = sorted(r["text"] for r in steps[4].collect())
    assert sorted(e.decode(r["ids"]) for r in steps[5].collect()) == texts


def test_run_and_empty_and_odd_tables(spark, steps):
    assert corpus_pipeline.run(spark, SF).count() == steps[5].count()
    for docs in (empty(spark), messy(spark)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() == 0 or docs.count() > 0


def test_the_library_stands_without_the_subpackage(tmp_path):
    for name in ("chanpulse", "__spark_entry__.py"):
        src, to = os.path.join(ROOT, name), os.path.join(tmp_path, name)
        if os.path.isdir(src):
            shutil.copytree(src, to, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, to)
    code = "import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); print(len(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=120)
    assert said.returncode == 0 and int(said.stdout) >= 56, said.stderr
