"""An analyzed copy of a text field, for collections that are searched often.

``postings`` holds one row per document and distinct token in folders by the token's hash, sorted by
token inside each file: a search opens the folders of its tokens only and skips through their
files by Parquet statistics.  A folder that a very common token makes large is split over as many
files as it needs.  ``lengths`` is one row of totals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan.functions import text as ta
from quillspan.functions.rows import unnest
from quillspan.operators.collection import bm25, inverse_document_frequency
from quillspan.operators.search import SCORE_DIGITS


BUCKETS = 64


@dataclass(frozen=True)
class Postings:
    rows: DataFrame
    lengths: DataFrame
    buckets: int


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def write_postings(df: DataFrame, id_col: str, field: str, path: str, buckets: int = BUCKETS) -> None:
    """Count the tokens of every document inside its row, then shuffle the counts once to their folders.

    The rebalance hint lets Spark split folders that came out large and join small ones.
    """
    words = df.select(F.col(id_col).alias("_id"), F.sort_array(ta.tokens(F.col(field))).alias("_sorted"))
    counted = words.select("_id", F.size("_sorted").alias("dl"), ta.token_counts("_sorted").alias("_counts"))
    rows = unnest(counted, "_counts", "_c").select(
        "_c.token", "_id", "_c.tf", "dl", _bucket(F.col("_c.token"), buckets).alias("bucket")
    )
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token").write.partitionBy("bucket").parquet(
        f"{path}/postings"
    )
    # Documents without tokens are in no row, but they count: the totals come from both sides.
    words_in_all = df.sparkSession.read.parquet(f"{path}/postings").agg(F.sum("tf")).scalar()
    lengths = df.agg(F.count(F.lit(1)).alias("n")).select(
        "n", (F.coalesce(words_in_all, F.lit(0)) / F.col("n")).alias("avgdl"), F.lit(buckets).alias("buckets")
    )
    lengths.write.parquet(f"{path}/lengths")


def read_postings(spark: SparkSession, path: str) -> Postings:
    lengths = spark.read.parquet(f"{path}/lengths")
    return Postings(spark.read.parquet(f"{path}/postings"), lengths, lengths.first()["buckets"])


def match_postings(postings: Postings, text: str, operator: str = "or") -> DataFrame:
    """``_id, score`` of the documents that match ``text``, with the same scores as a scan.

    Reads the rows of the query's tokens only and shuffles one row per document and token.
    """
    wanted = ta.distinct_in_order(ta.query_tokens(text))
    folders = F.col("bucket").isin([_bucket(F.lit(t), postings.buckets) for t in wanted])
    hits = postings.rows.where(folders & F.col("token").isin(wanted))
    frequency = hits.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    totals = postings.lengths.select(F.struct("n", "avgdl").alias("s")).scalar()
    counts = frequency.agg(F.map_from_entries(F.collect_list(F.struct("token", "df")))).scalar()
    per_token = []
    for t in wanted:
        idf = inverse_document_frequency(totals["n"], F.coalesce(F.try_element_at(counts, F.lit(t)), F.lit(0)))
        tf = F.max(F.when(F.col("token") == t, F.col("tf")))
        per_token.append((F.coalesce(tf, F.lit(0)).cast("double"), idf))
    docs = hits.groupBy("_id").agg(
        F.first("dl").cast("double").alias("dl"),
        F.count(F.lit(1)).alias("held"),
        *[tf.alias(f"tf{i}") for i, (tf, _) in enumerate(per_token)],
    )
    if operator == "and":
        docs = docs.where(F.col("held") == len(wanted))
    score = sum(
        (bm25(F.col(f"tf{i}"), F.col("dl"), idf, totals["avgdl"]) for i, (_, idf) in enumerate(per_token)),
        F.lit(0.0),
    )
    return docs.select("_id", F.round(score, SCORE_DIGITS).alias("score"))
