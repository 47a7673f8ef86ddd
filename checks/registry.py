"""Where queries register themselves, and what several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillspan.sources.readers import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The token pattern as SQL text.
WORD = r"[\p{L}\p{M}\p{N}_]+(?:''[\p{L}\p{M}\p{N}_]+)*"


class Tables:
    """``tables(name)`` reads a table; the session and the folder are at hand for streams."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __call__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def stream(self, name: str) -> DataFrame:
        # As a pattern, since a stream takes no single file; a table that is a folder gives all its files.
        return self.spark.readStream.schema(self(name).schema).parquet(f"{self.folder.rstrip('/')}/{name}[.]parquet")


def check(name: str, sql: str | None = None):
    """Register a query over ``table(name)`` under ``name``."""

    def register(query):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def words_sql(text: str = "text") -> str:
    return f"regexp_extract_all(lower({text}), '{WORD}')"


def tf_sql(term: str, words: str = "t") -> str:
    return f"len(list_filter({words}, lambda w: w = '{term}'))"


def corpus_sql(terms: list[str], table: str = "documents", text: str = "text") -> str:
    """CTEs ``d`` (rows with their words ``t``) and ``s`` (corpus statistics of the terms)."""
    counts = ", ".join(f"count(*) FILTER (WHERE list_contains(t, '{x}')) AS df{i}" for i, x in enumerate(terms))
    return (
        f"d AS (SELECT *, {words_sql(text)} AS t FROM {table}), "
        f"s AS (SELECT count(*) AS n, avg(len(t)) AS avgdl, {counts} FROM d)"
    )


def weight_sql(i: int, term: str) -> str:
    """The relevance of one term of :func:`corpus_sql`."""
    tf = tf_sql(term)
    return (
        f"(CASE WHEN {tf} > 0 THEN ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * ({tf} * 2.2) / "
        f"({tf} + 1.2 * (0.25 + 0.75 * len(t) / avgdl)) ELSE 0.0::DOUBLE END)"
    )


def bm25_sql(terms: list[str], only: list[str] | None = None) -> str:
    return "(" + " + ".join(weight_sql(i, x) for i, x in enumerate(terms) if only is None or x in only) + ")"


def any_sql(terms: list[str]) -> str:
    return "(" + " OR ".join(f"list_contains(t, '{x}')" for x in terms) + ")"


def all_sql(terms: list[str]) -> str:
    return "(" + " AND ".join(f"list_contains(t, '{x}')" for x in terms) + ")"
