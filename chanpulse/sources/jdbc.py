"""Export of a table frame to a relational database over JDBC.

The frame is written by the executors in parallel (one connection per
partition, ``numPartitions`` caps them), replacing the target table.  The
driver jar of the database must be on the classpath; none is shipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                mode: str = "overwrite", num_partitions: int | None = None,
                batch_size: int = 10000) -> None:
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
