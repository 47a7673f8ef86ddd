"""Rows from arrays and maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, values: Column | str, *names: str, position: str | None = None) -> DataFrame:
    """One row per element (one name) or map entry (two names) beside the other columns.

    The plain generators make Spark test the size of their input below the projection that
    computes it, so that a parse or an analysis runs twice; the outer ones do not.
    """
    if position:
        out = df.select("*", F.posexplode_outer(values).alias(position, *names))
        return out.where(F.col(position).isNotNull())
    out = df.select("*", F.explode_outer(values).alias(*names))
    return out.where(F.col(names[0]).isNotNull())
