"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quillspan.plans.durable import materialize

__all__ = ["Bitmap", "by_batch", "cut", "keyed", "one_text"]

cut = materialize


def one_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id`` and ``_text`` alone, whatever else the table has and however it is named."""
    return df.select(df[id_col].alias("_id"), df[text_col].cast("string").alias("_text"))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_key``, ``_id``, ``_text``: equal rows have one key, which a second scan finds again.

    The key is a 128-bit digest, so no two different rows of any real corpus share it.
    """
    rows = one_text(df, id_col, text_col)
    digest = F.md5(F.concat_ws("\x01", F.coalesce(F.col("_id").cast("string"), F.lit("\x02")), F.coalesce("_text", F.lit("\x02"))))
    return rows.select(F.unhex(digest).alias("_key"), "_id", "_text")


class Bitmap:
    """Which hashes occur, by their upper ``bits`` bits: no false negatives, and of one size whatever it holds."""

    def __init__(self, hashes: DataFrame, column: str, bits: int):
        top = f"shiftrightunsigned({column}, {64 - bits})"
        rows = (
            hashes.select(F.expr(f"shiftright({top}, 6)").alias("at"), F.expr(f"shiftleft(1L, cast({top} % 64 as int))").alias("bit"))
            .groupBy("at")
            .agg(F.bit_or("bit").alias("word"))
            .toArrow()  # at most 2 ** (bits - 6) rows
        )
        words = np.zeros(1 << (bits - 6), np.int64)
        words[rows["at"].to_numpy()] = rows["word"].to_numpy()
        self.bits, self.bytes = bits, words.view(np.uint8)

    @classmethod
    def of(cls, data: np.ndarray, bits: int) -> Bitmap:
        """The bitmap whose bytes are known."""
        self = cls.__new__(cls)
        self.bits, self.bytes = bits, data
        return self

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def by_batch(
    df: DataFrame, schema: T.StructType | str, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """Apply ``work`` to each Arrow batch, in Spark's tasks."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)
