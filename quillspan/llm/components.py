"""Connected components of a graph given by its edges, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillspan.llm.common import cut


def _stars(edges: DataFrame, upward: bool) -> DataFrame:
    """Link the neighbours of each node (the larger ones, or the smaller ones and itself) to their least."""
    both = edges if not upward else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut(both, "both") if upward else both
    least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    linked = both.join(least, "a")
    if upward:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return cut(out.where("a > b").distinct(), "stars")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges(a, b)``; the label is the least node of its component.

    Each round joins every edge with one value per node, so no neighbourhood is gathered; the number of rounds
    grows with the logarithm of the longest path.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    mark = _mark(now)
    while True:
        now = _stars(_stars(now, upward=True), upward=False)
        new = _mark(now)
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
