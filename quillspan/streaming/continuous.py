"""Collections kept up to date, searched and counted as streams."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspan.functions.rows import unnest
from quillspan.operators.aggs import Bucket
from quillspan.operators.clauses import Clause
from quillspan.operators.search import matching
from quillspan.operators.writes import bulk_apply
from quillspan.sources.store import Store


def continuous_upsert(
    actions: DataFrame, store: Store, checkpoint: str, scripts=None, apply=bulk_apply, **trigger
) -> StreamingQuery:
    """Apply every micro-batch of write actions to the store.

    The store holds a version, which may be empty, before the stream starts.  Every batch makes the
    next one and is noted with the stream's id, which its checkpoint keeps over restarts, so a batch that is
    run again after a failure changes nothing and no other is passed over.
    """
    if store.latest() is None:
        raise ValueError(f"nothing has been committed under {store.path}")

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        stream = json.loads(store.spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        if not store.has_batch(stream, batch_id):
            store.apply(batch, scripts=scripts, apply=apply, stream=stream, batch=batch_id)

    return (
        actions.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def standing_query(stream: DataFrame, query: Clause | list) -> DataFrame:
    """The documents of a stream that match; needs no state and no corpus statistics."""
    return matching(stream, query)


def _timed(stream: DataFrame, time_col: str, late: str) -> DataFrame:
    """Event time has to be an instant; a wall-clock time is read in the session's time zone."""
    return stream.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, late)


def windowed_terms(
    stream: DataFrame, time_col: str, field: str, window: str, late: str, slide: str | None = None
) -> DataFrame:
    """Documents per value and event-time window; ``late`` is how long a window waits."""
    return (
        _timed(stream, time_col, late)
        .where(F.col(field).isNotNull())
        .groupBy(F.window(time_col, window, slide), F.col(field).alias("key"))
        .agg(F.count(F.lit(1)).alias("doc_count"))
        .select(F.col("window.start").alias("window_start"), "key", "doc_count")
    )


def windowed_ranges(
    stream: DataFrame, time_col: str, field: str, buckets: list[Bucket], window: str, late: str
) -> DataFrame:
    """Documents per named range, which may overlap, and event-time window."""
    held = [F.when(b.holds(F.col(field)), F.lit(b.key)) for b in buckets if b is not None]
    return (
        unnest(_timed(stream, time_col, late), F.array_compact(F.array(*held)), "key")
        .groupBy(F.window(time_col, window), "key")
        .agg(F.count(F.lit(1)).alias("doc_count"))
        .select(F.col("window.start").alias("window_start"), "key", "doc_count")
    )


def keep_updates(counts: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write the changed counts of every micro-batch to a folder of its own under ``path``."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of each window and key among the batches under ``path``."""
    return (
        spark.read.parquet(path)
        .groupBy("window_start", "key")
        .agg(F.max_by("doc_count", "batch").alias("doc_count"))
    )
