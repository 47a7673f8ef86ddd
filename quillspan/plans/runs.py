"""Running values along the ordered rows of a key, safe for keys of any size.

A window puts all rows of a key into one task.  That is the cheapest plan for keys of ordinary
size; :func:`split_hot` sets apart the keys with more than ``chunk`` rows.  Those rows are ranked by
key and order, and the ranks cut into ranges of ``chunk``, so a (key, range) group holds at most
``chunk`` rows however far apart the order's numbers are: a window runs inside each group, one
summary row per group is carried along the key, and the carried value is joined back to the group.

Keys and order must not be NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspan.plans.rowindex import with_row_index

CHUNK = 1_000_000


def split_hot(keyed: DataFrame, keys: list[str], chunk: int) -> DataFrame | None:
    """The keys with more than ``chunk`` rows, or ``None`` if there are none.

    Counting is a partial aggregate over the key columns.  There are at most rows / ``chunk``
    such keys; whether they are broadcast is left to Spark, which sees their size.
    """
    hot = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > chunk).select(*keys)
    return None if hot.isEmpty() else hot


def chunked(df: DataFrame, keys: list[str], order: str, chunk: int) -> DataFrame:
    """Add ``_chunk``, a number that grows along ``order`` and that at most ``chunk`` rows share."""
    ranked = with_row_index(df, [F.col(c) for c in (*keys, order)], "_rank")
    return ranked.withColumn("_chunk", F.expr(f"_rank div {int(chunk)}")).drop("_rank")


def last_before(
    df: DataFrame, keys: list[str], order: str, values: dict[str, Column], chunk: int | None = None
) -> DataFrame:
    """For every row and value, the latest non-NULL value on an earlier row of the same key.

    Without ``chunk`` one window does it; with it, keys may be of any size.
    """
    held = {f"_v_{out}": value for out, value in values.items()}
    if chunk is None:
        inside = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        rows = df.withColumns(held)
        return rows.withColumns({out: F.last(f"_v_{out}", ignorenulls=True).over(inside) for out in values}).drop(*held)

    groups = [*keys, "_chunk"]
    rows = chunked(df, keys, order, chunk).withColumns(held)
    inside = W.partitionBy(*groups).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({f"_in_{out}": F.last(f"_v_{out}", ignorenulls=True).over(inside) for out in values})
    ends = rows.groupBy(*groups).agg(
        *[
            F.max_by(f"_v_{out}", F.when(F.col(f"_v_{out}").isNotNull(), F.col(order))).alias(f"_end_{out}")
            for out in values
        ]
    )
    along = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        *groups, *[F.last(f"_end_{out}", ignorenulls=True).over(along).alias(f"_carry_{out}") for out in values]
    )
    joined = rows.join(carried, groups)
    return joined.withColumns(
        {out: F.coalesce(F.col(f"_in_{out}"), F.col(f"_carry_{out}")) for out in values}
    ).drop("_chunk", *held, *[f"_in_{o}" for o in values], *[f"_carry_{o}" for o in values])


def running_sum(
    df: DataFrame, keys: list[str], order: str, values: dict[str, Column], chunk: int | None = None
) -> DataFrame:
    """For every row and value, the sum over this and all earlier rows of the same key.

    Without ``chunk`` one window does it; with it, keys may be of any size.
    """
    held = {f"_v_{out}": value.cast("bigint") for out, value in values.items()}
    if chunk is None:
        inside = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
        rows = df.withColumns(held)
        return rows.withColumns({out: F.sum(f"_v_{out}").over(inside) for out in values}).drop(*held)

    groups = [*keys, "_chunk"]
    rows = chunked(df, keys, order, chunk).withColumns(held)
    inside = W.partitionBy(*groups).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumns({f"_in_{out}": F.sum(f"_v_{out}").over(inside) for out in values})
    sums = rows.groupBy(*groups).agg(*[F.sum(f"_v_{out}").alias(f"_all_{out}") for out in values])
    along = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(
        *groups,
        *[F.coalesce(F.sum(f"_all_{out}").over(along), F.lit(0)).alias(f"_carry_{out}") for out in values],
    )
    joined = rows.join(carried, groups)
    return joined.withColumns({out: F.col(f"_in_{out}") + F.col(f"_carry_{out}") for out in values}).drop(
        "_chunk", *held, *[f"_in_{o}" for o in values], *[f"_carry_{o}" for o in values]
    )


def by_heat(df: DataFrame, keys: list[str], hot: DataFrame | None, chunk: int, scan) -> DataFrame:
    """``scan(rows, chunk or None)`` over the ordinary keys and, apart from them, the hot ones."""
    if hot is None:
        return scan(df, None)
    # Spark 4.1 may take a union of two joins on the same keys for partitioned by them, and an aggregate
    # behind it then misses rows; without that shortcut it shuffles, as earlier versions do.
    df.sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    return scan(df.join(hot, keys, "left_anti"), None).unionByName(scan(df.join(hot, keys, "left_semi"), chunk))
