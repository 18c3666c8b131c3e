"""The warehouse tables: typed Parquet tables in Spark's catalog.

``CREATE TABLE IF NOT EXISTS`` gives each table its columns, its partition column (the month
of its time column, which Spark prunes by) and its buckets (hashed and sorted by the key), so
any session finds it by name, and a join on the key reads the buckets in place.  Rows are
written by Spark's own writer with dynamic partition overwrite: the partitions that a frame
holds are replaced, all others stay.  Files are staged and moved when the job commits, so a
job that fails leaves the table as it was; a merge may therefore read the table it writes.
The move itself is partition by partition.  A load that dies there is run again: an upsert by
key of the same batch gives the same rows.  One writer at a time is assumed, as with the
daily job this serves.

A session whose catalog doesn't know the tables yet (Spark's in-memory catalog ends with the
application) registers them over the same folders.  The bucket count is fixed when a table is
made; its folder is named after it.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from . import fs


@dataclass(frozen=True)
class Table:
    spark: SparkSession
    name: str             # database.table
    schema: StructType    # without the partition column
    keys: tuple[str, ...]
    time: str             # its month is the partition
    month: str            # the partition column
    buckets: int
    id_col: str = "id"
    stamp: str | None = None  # the snapshot a row's values are of; not part of ``read``

    @property
    def columns(self) -> list[str]:
        """What a merge reads and writes: the columns of ``read``, and the stamp."""
        return [*self.schema.fieldNames(), *([self.stamp] if self.stamp else [])]

    def stored(self) -> DataFrame:
        """All columns, the partition column included."""
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        return self.stored().select(*self.schema.fieldNames())

    def by_key(self) -> bool:
        """Whether a row's key tells its partition."""
        return self.time in self.keys

    def month_of(self, time: Column | None = None) -> Column:
        return F.trunc(F.col(self.time) if time is None else time, "month")

    def of_months(self, months: list) -> DataFrame:
        """``stored`` rows of some partitions."""
        return self.stored().filter(F.col(self.month).isin(months)) if months \
            else self.stored().limit(0)

    def dealt(self, df: DataFrame) -> DataFrame:
        """``df`` shuffled by month and bucket, so each bucket of a month is one task's."""
        return df.repartition(self.month_of(), F.pmod(F.hash(*self.keys), F.lit(self.buckets)))

    def overwrite(self, df: DataFrame) -> None:
        """Replace the partitions that ``df`` (of ``columns``) has rows of.  A task
        writes a file for each month and bucket that it holds rows of: ``df`` should be
        partitioned by the buckets, or :meth:`dealt`."""
        df.select(*self.columns, self.month_of().alias(self.month)) \
            .write.mode("overwrite").insertInto(self.name)


def database_of(spark: SparkSession, root: str) -> str:
    """The database of a warehouse folder, where none is named."""
    return "chanpulse_" + hashlib.sha1(fs.qualified(spark, root).encode()).hexdigest()[:12]


@dataclass(frozen=True)
class Partials:
    """A table of partial measures, partitioned like the table that they are of."""
    spark: SparkSession
    name: str
    schema: StructType
    month: str

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.schema.fieldNames())

    def overwrite(self, df: DataFrame) -> None:
        """Replace the partitions that ``df`` (with the partition column) has rows of."""
        df.select(*self.schema.fieldNames(), self.month).write.mode("overwrite") \
            .insertInto(self.name)


def _buckets(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])


def create(spark: SparkSession, root: str, database: str, table: str, schema: StructType,
           keys: list[str], time: str, month: str, buckets: int, stamp: str) -> Table:
    """Idempotent: the table is made, or found as it was made (without ``stamp``, if so)."""
    name, root = f"{database}.{table}", root.rstrip("/")
    if not spark.catalog.tableExists(name):
        for e in fs.list_dir(spark, root):
            if m := re.fullmatch(rf"{table}_(\d+)_buckets", e.name):
                buckets = int(m[1])
        key = ", ".join(keys)
        _register(spark, root, database, table, f"{table}_{buckets}_buckets",
                  T.StructType([*schema.fields, T.StructField(stamp, T.StringType())]), month,
                  f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(buckets)} BUCKETS")
    return Table(spark, name, schema, tuple(keys), time, month, _buckets(spark, name),
                 stamp=stamp if stamp in spark.table(name).columns else None)


def create_partials(spark: SparkSession, root: str, database: str, table: str,
                    schema: StructType, month: str) -> Partials:
    """Idempotent, like :func:`create`."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        _register(spark, root.rstrip("/"), database, table, table, schema, month, "")
    return Partials(spark, f"{database}.{table}", schema, month)


def _register(spark: SparkSession, root: str, database: str, table: str, folder: str,
              schema: StructType, month: str, layout: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    fs.make_dir(spark, f"{root}/{folder}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}, {month} DATE)
        USING parquet OPTIONS ('partitionOverwriteMode' = 'dynamic') PARTITIONED BY ({month})
        {layout} LOCATION '{root}/{folder}'""")
    spark.catalog.recoverPartitions(f"{database}.{table}")
