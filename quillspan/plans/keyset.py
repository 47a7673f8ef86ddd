"""Export in pages without writing the rows anew: ranges of the sort key, and pages that continue after a key.

One pass over the key columns alone cuts the order into ranges of about ``rows`` documents and counts each. Page ``n``
then asks the collection for the keys of the ranges it lies in, as plain comparisons that reach the scan, and sorts those
rows only; a page after a key asks for the keys behind it. Files that are clustered by the leading sort column are skipped by their
statistics.

The order must be total, which the id ensures, and the collection must not change between pages, as a version of
a store does not. Nulls come last, ascending or descending; NaN is above all numbers, as in Spark's order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from quillspan.operators.search import sort_columns
from quillspan.plans.durable import materialize

RANGE_ROWS = 50_000
# monotonically_increasing_id() keeps the partition in the upper bits and the row in the lower 33.
_ROW_BITS = 33


def _key(sort: list[tuple[str, str]], id_col: str) -> list[tuple[str, bool]]:
    """The columns of the order and whether each descends; the id comes last unless it is asked for before."""
    key = [(name, way == "desc") for name, way in sort]
    return key if any(name == id_col for name, _ in key) else [*key, (id_col, False)]


def _behind(name: str, descending: bool, value) -> Column:
    if value is None:
        return F.lit(False)
    column = F.col(name)
    return (column < F.lit(value) if descending else column > F.lit(value)) | column.isNull()


def _same(name: str, value) -> Column:
    return F.col(name).isNull() if value is None else F.col(name) == F.lit(value)


def after(key: list[tuple[str, bool]], values: tuple) -> Column:
    """Whether a row stands behind ``values``; the leading column alone is compared as well, for the scan."""
    found = F.lit(False)
    for (name, descending), value in reversed(list(zip(key, values))):
        found = _behind(name, descending, value) | (_same(name, value) & found)
    (name, descending), value = key[0], values[0]
    return found & (_behind(name, descending, value) | _same(name, value))


def up_to(key: list[tuple[str, bool]], values: tuple) -> Column:
    """Whether a row stands at or before ``values``."""
    found, (name, descending), value = ~F.coalesce(after(key, values), F.lit(False)), key[0], values[0]
    if value is None:
        return found
    return found & (F.col(name) >= F.lit(value) if descending else F.col(name) <= F.lit(value))


class Keyset:
    """Pages of ``df`` under ``sort`` and the id."""

    def __init__(self, df: DataFrame, sort: list[tuple[str, str]], id_col: str = "_id", rows: int = RANGE_ROWS):
        self.df = df
        self.key = _key(sort, id_col)
        self.order = sort_columns(sort, id_col)
        names = [name for name, _ in self.key]
        keys = df.select(*names)
        parts = max(1, -(-keys.count() // rows))
        ranged = keys.repartitionByRange(parts, *self.order).sortWithinPartitions(*self.order)
        numbered = ranged.withColumn("_at", F.monotonically_increasing_id())
        key = F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(names)))
        counted = numbered.groupBy(F.shiftright("_at", _ROW_BITS).alias("range_no")).agg(
            F.count(F.lit(1)).alias("n"), F.min_by(key, "_at").alias("first"), F.max_by(key, "_at").alias("last")
        )
        # One row per range from here on.
        along = Window.orderBy("range_no")
        before = F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        self.ranges = materialize(counted.withColumns({"start": before, "previous": F.lag("last").over(along)}), "ranges")

    def page(self, number: int, size: int) -> DataFrame:
        """Page ``number``, counted from 0, in order; behind the last page no rows."""
        first = number * size
        touched = self.ranges.where((F.col("start") < first + size) & (F.col("start") + F.col("n") > first))
        ends = touched.agg(F.min("start").alias("start"), F.min_by("previous", "start").alias("previous"), F.max_by("last", "start").alias("last")).first()
        if ends["start"] is None:
            return self.df.limit(0)
        bounds = [up_to(self.key, tuple(ends["last"]))]
        if ends["previous"] is not None:
            bounds.append(after(self.key, tuple(ends["previous"])))
        inside = self.df.where(reduce(lambda a, b: a & b, bounds))
        return inside.orderBy(*self.order).offset(first - ends["start"]).limit(size)

    def after(self, last: Row | dict, size: int) -> DataFrame:
        """The ``size`` rows that follow the row ``last``, which need not exist any more."""
        values = tuple(last[name] for name, _ in self.key)
        return self.df.where(after(self.key, values)).orderBy(*self.order).limit(size)
