"""File listing through Hadoop's FileSystem API, so the same code lists a
local folder, HDFS or an object store (whatever scheme the path names).
Only names, sizes and times travel to the driver, never file contents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    mtime_ms: int
    is_dir: bool


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dir(spark: SparkSession, path: str) -> list[Entry]:
    """Direct children of ``path``; an absent folder lists as empty."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        q = st.getPath()
        out.append(Entry(q.getName(), q.toString(), int(st.getModificationTime()),
                         bool(st.isDirectory())))
    return out


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def make_dir(spark: SparkSession, path: str) -> None:
    """Create a folder and those above it, where they are missing."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as Spark takes it."""
    fs, p = _fs(spark, path)
    return str(fs.makeQualified(p).toString())
