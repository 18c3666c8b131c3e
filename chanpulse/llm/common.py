"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import functools
import io
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanpulse.llm.textarrays import release
from chanpulse.session import scratch_path

#: A word: a run of anything but ASCII white space (space and 0x09 to 0x0D).
WORD = r"[^\x20\x09-\x0D]+"
#: What stands between words.
GAP = r"[\x20\x09-\x0D]+"


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and reread it.

    It cuts the lineage: lost executors cost no more than the step at hand, and
    values that depend on the physical plan (a partition's number) stay fixed.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a full URI, the way Spark takes it: where it names no scheme it is of the
    default file system, not of the disk of whoever opens it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = fs.makeQualified(p).toString()
    return "file://" + full.removeprefix("file:") if full.startswith("file:/") \
        and not full.startswith("file://") else full


#: Rows that go to a Python worker at once; texts are long, and so are their ids.
BATCH_ROWS = 1_000
_shipped: set[str] = set()


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS, which bounds a worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "0")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def ship(spark: SparkSession) -> None:
    """Let the workers import this package, wherever they start (once a context)."""
    small_batches(spark)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    folder = tempfile.mkdtemp()  # the driver's own; Spark hands the file to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "chanpulse.zip")
    with open(path, "wb") as f:
        f.write(packed.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def arrow_udf(run, kind: str):
    """``F.arrow_udf`` for code of this package; releases memory after each batch."""
    ship(SparkSession.active())

    @functools.wraps(run)
    def lean(*columns):
        out = run(*columns)
        release()
        return out

    return F.arrow_udf(lean, kind)


def map_in_arrow(df: DataFrame, run, kind: str) -> DataFrame:
    """``df.mapInArrow`` for code of this package; releases memory after each batch."""
    ship(df.sparkSession)

    def lean(batches):
        for out in run(batches):
            yield out
            release()

    return df.mapInArrow(lean, kind)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """One row in five, by crc32 of the id as text; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0,
                      F.lit(False))


def parts_for(rows: int, per_part: int) -> int:
    return max(1, -(-rows // per_part))
