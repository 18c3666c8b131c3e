"""Records that were judged usable or not, and the one pass that parts them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

_USABLE = "_usable"


@dataclass(frozen=True)
class Judged:
    """Parsed records with a ``reason`` (NULL where a record can be used), the usable rows
    and the rejects.

    As it stands each of the two is a query of its own over the raw input.  ``parted`` parses
    the input once: every record is written to the shared checkpoint folder, partitioned by
    whether it can be used, and both sides are read back from their own folder."""
    frame: DataFrame
    as_rows: Callable[[DataFrame], DataFrame]
    as_rejects: Callable[[DataFrame], DataFrame]
    usable: Column | None = None

    @property
    def rows(self) -> DataFrame:
        kept = F.col("reason").isNull() if self.usable is None else self.usable
        return self.as_rows(self.frame.filter(kept))

    @property
    def rejects(self) -> DataFrame:
        kept = F.col("reason").isNull() if self.usable is None else self.usable
        return self.as_rejects(self.frame.filter(~kept))

    def then(self, step: Callable[[DataFrame], DataFrame]) -> "Judged":
        """The same, with ``step`` after the usable rows."""
        return Judged(self.frame, lambda df: step(self.as_rows(df)), self.as_rejects, self.usable)

    def parted(self, name: str) -> "Judged":
        spark = self.frame.sparkSession
        path = scratch_path(spark, name)
        self.frame.withColumn(_USABLE, F.col("reason").isNull()) \
            .write.partitionBy(_USABLE).parquet(path)
        schema = T.StructType([*self.frame.schema.fields, T.StructField(_USABLE, T.BooleanType())])
        return Judged(spark.read.schema(schema).parquet(path), self.as_rows, self.as_rejects,
                      F.col(_USABLE))
