"""Streams read from the tables' files until they are used up."""

from __future__ import annotations

from pyspark.sql import functions as F  # noqa: F401

import quillspan as q
from checks.registry import check, words_sql
from quillspan.plans.durable import new_folder
from quillspan.streaming.continuous import (
    keep_updates,
    latest_counts,
    standing_query,
    windowed_ranges,
    windowed_terms,
)
from quillspan.functions import text as ta
from quillspan.streaming.percolate import standing_queries


@check(
    "q_stream_filter",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('error', 'purchase') AND value >= 20",
)
def stream_filter(table):
    out = new_folder(table.spark, "matches")
    hits = standing_query(
        table.stream("events"), [q.terms("event_type", ["error", "purchase"]), q.range_("value", ("gte", 20))]
    )
    query = (
        hits.select("event_id", "user_id", "event_type", "value")
        .writeStream.format("parquet")
        .option("checkpointLocation", new_folder(table.spark, "progress"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return table.spark.read.parquet(out)


def counted(table, counts):
    out = new_folder(table.spark, "counts")
    keep_updates(counts, out, new_folder(table.spark, "progress")).awaitTermination()
    return latest_counts(table.spark, out)


@check(
    "q_stream_terms",
    "SELECT date_trunc('day', ts) AS window_start, event_type AS key, count(*) AS doc_count FROM events GROUP BY 1, 2",
)
def stream_terms(table):
    return counted(table, windowed_terms(table.stream("events"), "ts", "event_type", "1 day", "2 days"))


@check(
    "q_stream_ranges",
    "SELECT date_trunc('day', ts) AS window_start, key, count(*) AS doc_count FROM events, "
    "(VALUES ('low', 0, 100), ('middle', 50, 300), ('high', 200, 1000000)) b(key, lo, hi) "
    "WHERE value >= lo AND value < hi GROUP BY 1, 2",
)
def stream_ranges(table):
    buckets = [q.bucket("low", 0.0, 100.0), q.bucket("middle", 50.0, 300.0), q.bucket("high", 200.0)]
    return counted(table, windowed_ranges(table.stream("events"), "ts", "value", buckets, "1 day", "2 days"))


# Each benchmark item asks for two of its words, documents of one language and a least length, and not for a third word.
@check(
    "q_stream_percolate",
    f"WITH b AS (SELECT item_id, {words_sql()} AS w FROM benchmark), d AS (SELECT *, {words_sql()} AS t FROM documents) "
    "SELECT doc_id, item_id::VARCHAR AS query_id FROM d, b WHERE len(w) >= 5 AND list_contains(t, w[2]) AND list_contains(t, w[4]) "
    "AND lang = ['en', 'de', 'fr', 'es'][item_id % 4 + 1] AND n_chars >= item_id % 5 * 500 AND NOT list_contains(t, w[5])",
)
def stream_percolate(table):
    words = table("benchmark").select("item_id", ta.tokens(F.col("text")).alias("w")).where(F.size("w") >= 5)
    term = lambda field, value: F.struct(F.lit(field).alias("field"), value.alias("value"))
    lang = F.get(F.array(*map(F.lit, ["en", "de", "fr", "es"])), F.col("item_id") % 4)
    queries = words.select(
        F.col("item_id").cast("string").alias("query_id"),
        F.array(term("text", F.get("w", F.lit(1))), term("lang", lang), term("text", F.get("w", F.lit(3)))).alias("required"),
        F.array(term("text", F.get("w", F.lit(4)))).alias("excluded"),
        F.array(F.struct(F.lit("n_chars").alias("field"), (F.col("item_id") % 5 * 500).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))).alias("ranges"),
    )
    out = new_folder(table.spark, "matches")
    standing_queries(
        table.stream("documents"), queries, out, new_folder(table.spark, "progress"), "doc_id", ["text"], ["lang"], ["n_chars"]
    ).awaitTermination()
    return table.spark.read.parquet(out).select("doc_id", "query_id")
