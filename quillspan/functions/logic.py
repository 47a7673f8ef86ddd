"""Combining lists of columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns) if columns else F.lit(False)


def all_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns) if columns else F.lit(True)


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns) if columns else F.lit(0.0)
