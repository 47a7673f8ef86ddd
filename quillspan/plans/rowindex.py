"""Global row numbers without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspan.plans.durable import materialize

# monotonically_increasing_id() keeps the partition in the upper bits and the row in the lower 33.
_ROW_BITS = 33


def with_row_index(df: DataFrame, order: list[Column], name: str = "row_index") -> DataFrame:
    """Add the 0-based rank of each row under ``order``, which must be a total order.

    Rows are range-partitioned and sorted once, numbered inside their partition and written;
    the partition sizes (one row per partition) give every partition its first number.  The
    write fixes the partitions, so both uses of them agree even if executors are lost.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = materialize(
        ranged.withColumn("_index_at", F.monotonically_increasing_id()).select(
            "*",
            F.shiftright("_index_at", _ROW_BITS).alias("_index_part"),
            F.col("_index_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_index_row"),
        ).drop("_index_at"),
        "rowindex",
    )
    before = W.orderBy("_index_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("_index_part")
        .agg(F.count(F.lit(1)).alias("_index_n"))
        .select("_index_part", F.coalesce(F.sum("_index_n").over(before), F.lit(0)).alias("_index_start"))
    )
    # One row per partition: bounded by the partition count, so it may always be broadcast.
    return (
        numbered.join(F.broadcast(starts), "_index_part")
        .withColumn(name, F.col("_index_start") + F.col("_index_row"))
        .drop("_index_part", "_index_row", "_index_start")
    )
