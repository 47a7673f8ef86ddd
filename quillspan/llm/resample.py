"""Drawing the documents that look most like a target: hashed n-gram importance weights, Gumbel noise, exact top k.

The runs of one to ``LONGEST`` words of all texts fall into ``BUCKETS`` buckets by their CRC-32. A first pass counts
the buckets of the documents and of the target texts (partial sums in the tasks, one row a bucket after the shuffle). A
bucket's gain is the logarithm of how much more often the target uses it; a text's weight is the sum of its gains, its
score the weight with noise from a digest of its id, so that taking the highest scores draws without replacement in
proportion to the weights.

CRCs are taken over arrays: a word's by steps over the bytes of all words at once, a run's from its parts, since
appending bytes to a text acts on its CRC as a linear map that depends on their number only.

The highest scores are found by a weighted median of medians. Each partition gives the median of the keys that are
still open and how many those are; the driver takes the weighted median of these medians; the next pass counts what lies
on either side and gives the medians of both. At least a quarter of the open keys lies on the side that is discarded, so the
rounds grow with the logarithm of the rows until one key is left, the cut-off. When few of the stored keys are open they are
written anew, so all rounds together read about as much as a few of the first. The driver sees one row per partition. Winners
alone are sorted and numbered.

Defined results: a null or empty text has no features and weight 0; ties go to the smaller id (nulls last), then to the row
that was written first, so repeated rows each have a result and a rank of their own; ids that are no integers are ordered
by their 64-bit hash; the noise of a null id is that of an empty one; an empty target gives every bucket the count 0; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quillspan.llm import words as W
from quillspan.llm.common import by_batch, cut
from quillspan.llm.registry import query, table
from quillspan.plans.durable import release
from quillspan.plans.rowindex import with_row_index

BUCKETS, LONGEST = 10_000, 3
LEAST_WORDS, PERCENT, SEED = 20, 5, 42
_SHORT = 64
_ONE_BIT = 1 << 33  # more than any text has bytes


def _steps() -> np.ndarray:
    """For 0 to ``_SHORT - 1`` appended zero bytes, what each of a CRC's four bytes becomes."""
    # Appending zeros is linear, so it is told by what it does to single bytes against what it does to none.
    table = np.empty((_SHORT, 4, 256), np.uint32)
    for j in range(4):
        table[0, j] = np.arange(256, dtype=np.uint32) << np.uint32(8 * j)
    byte = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    byte ^= byte[0]  # the linear part of one step, by the low byte
    for n in range(1, _SHORT):
        last = table[n - 1]
        table[n] = (last >> np.uint32(8)) ^ byte[last & np.uint32(255)]
    return table


_TABLE = _steps()
_FURTHER: list[np.ndarray] = []


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The linear map given by four tables of 256, or by one such set for each value."""
    parts = [(crc >> np.uint32(8 * j)) & np.uint32(255) for j in range(4)]
    return table[0][parts[0]] ^ table[1][parts[1]] ^ table[2][parts[2]] ^ table[3][parts[3]]


def _shift(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The linear part of appending ``n`` zero bytes."""
    low = n % _SHORT
    out = np.zeros_like(crc)
    for j in range(4):
        out ^= _TABLE[low, j, (crc >> np.uint32(8 * j)) & np.uint32(255)]
    high, k = n // _SHORT, 0
    while high.any():
        if len(_FURTHER) == k:
            # _SHORT steps, then twice as many each time.
            half = _TABLE[_SHORT // 2] if not k else _FURTHER[-1]
            _FURTHER.append(_apply(half, half))
        odd = np.flatnonzero(high & 1)
        out[odd] = _apply(_FURTHER[k], out[odd])
        high, k = high >> 1, k + 1
    return out


def _word_crcs(words: W.Words) -> np.ndarray:
    """The CRC-32 of each word, in steps over the bytes of all words that are long enough."""
    sizes = words.ends - words.starts
    out = np.zeros(len(sizes), np.uint32)
    register = np.full(len(sizes), 0xFFFFFFFF, np.uint32)
    byte = _TABLE[1, 0]  # one step by the low byte
    order = np.argsort(-np.minimum(sizes, _SHORT), kind="stable")
    starts, ascending = words.starts[order], -np.minimum(sizes, _SHORT)[order]
    raw = np.maximum(words.codes, 1) - 1  # A-Z are lower case here
    for j in range(int(min(sizes.max(initial=0), _SHORT))):
        rows = order[: np.searchsorted(ascending, -j, side="left")]
        at = register[rows]
        register[rows] = (at >> np.uint32(8)) ^ byte[(at ^ raw[starts[: len(rows)] + j]) & np.uint32(255)]
    out = register ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > _SHORT).tolist():
        out[i] = zlib.crc32(raw[words.starts[i] : words.ends[i]].astype(np.uint8))
    return out


def _features(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each feature and the text it belongs to."""
    sizes, rows = words.ends - words.starts, words.rows
    word = _word_crcs(words)
    blank = np.full(len(word), zlib.crc32(b" "), np.uint32)
    spaced = _shift(blank, sizes) ^ word  # of a blank and the word
    crcs, owners, run = [word], [rows], word
    for n in range(1, LONGEST):
        run = _shift(run[:-1], sizes[n:] + 1) ^ spaced[n:] if len(run) > 1 else run[:0]
        inside = rows[: len(run)] == rows[n : n + len(run)]
        crcs.append(run[inside])
        owners.append(rows[: len(run)][inside])
    return np.concatenate(crcs) % np.uint32(BUCKETS), np.concatenate(owners)


def _count(batches):
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, words in W.chunks(batch.column("_text"), W.ALNUM_FOLDED):
            counts += np.bincount(_features(words)[0], minlength=BUCKETS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    rows = texts.select(texts[text_col].cast("string").alias("_text"))
    found = rows.mapInArrow(_count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What one feature of each bucket adds to a weight, in thousandths."""
    s, t = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((b + 1) * s / ((a + 1) * t))) for a, b in pairs], np.int64)


def _noise(ids: list, seed: int) -> np.ndarray:
    """Gumbel noise from the digests of ids, in thousandths."""
    h = np.array([int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16) for i in ids], np.float64)
    return np.floor(-1000 * np.log(-np.log((h + 0.5) / 4294967296))).astype(np.int64)


def _score(shared, seed: int):
    def work(batch):
        gain = shared.value
        names = [c for c in batch.schema.names if c not in ("_text", "_id")]
        for a, b, words in W.chunks(batch.column("_text"), W.ALNUM_FOLDED):
            part = batch.slice(a, b - a)
            buckets, rows = _features(words)
            n = np.bincount(rows, minlength=b - a).astype(np.int64)
            # Sums of doubles are exact here: a text has far fewer features than 2 ** 53 / gain.
            weight = np.bincount(rows, gain[buckets], b - a).astype(np.int64)
            score = weight + _noise(part.column("_id").to_pylist(), seed)
            arrays = [*(part.column(c) for c in names), *map(pa.array, (words.counts.astype(np.int64), n, weight, score))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_words", "n_features", "weight", "score"])

    return work


Key = tuple[int, int, int]  # negative score, id, row: ascending from the best


def _columns(batch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in ("_neg", "_order", "_row")])


def _before(keys: np.ndarray, key: Key) -> np.ndarray:
    a, b, c = keys
    return (a < key[0]) | (a == key[0]) & ((b < key[1]) | (b == key[1]) & (c < key[2]))


def _median(keys: np.ndarray) -> list:
    if not keys.shape[1]:
        return [None] * 3
    return keys[:, np.lexsort(keys[::-1])[(keys.shape[1] - 1) // 2]].tolist()


def _sides(low: Key | None, high: Key | None, pivot: Key | None):
    """Of a partition's keys after ``low`` and before ``high``: number and median of those before and after ``pivot``."""

    def work(batches):
        held = []
        for batch in batches:
            keys = _columns(batch)
            if low is not None:
                keys = keys[:, ~_before(keys, low) & ~(keys == np.array(low)[:, None]).all(0)]
            if high is not None:
                keys = keys[:, _before(keys, high)]
            held.append(keys)
        keys = np.concatenate(held, axis=1) if held else np.zeros((3, 0), np.int64)
        if not keys.shape[1]:
            return
        if pivot is None:
            sides = [keys[:, :0], keys]
        else:
            first = _before(keys, pivot)
            sides = [keys[:, first], keys[:, ~first & ~(keys == np.array(pivot)[:, None]).all(0)]]
        for name, side in zip((False, True), sides):
            if side.shape[1]:
                values = [name, side.shape[1], *_median(side)]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["after", "n", "a", "b", "c"])

    return work


def _weighted_median(rows) -> Key:
    rows = sorted(rows, key=lambda r: (r["a"], r["b"], r["c"]))
    half = sum(r["n"] for r in rows) / 2
    for r in rows:
        half -= r["n"]
        if half <= 0:
            return r["a"], r["b"], r["c"]


def cut_off(keys: DataFrame, k: int) -> Key | None:
    """The ``k``-th smallest key of ``keys(_neg, _order, _row)``, a written table of different keys; None beyond their number."""
    low = high = pivot = None
    own, first = None, keys
    stored = None
    while True:
        rows = keys.mapInArrow(_sides(low, high, pivot), "after boolean, n bigint, a bigint, b bigint, c bigint").collect()
        before, after = ([r for r in rows if r["after"] is side] for side in (False, True))
        n_before, n_after = (sum(r["n"] for r in side) for side in (before, after))
        if pivot is not None and k == n_before + 1:
            break
        if k <= n_before:
            high, side, left = pivot, before, n_before
        else:
            k -= n_before + (pivot is not None)
            low, side, left = pivot if pivot is not None else low, after, n_after
        if not 0 < k <= left:
            pivot = None
            break
        pivot = _weighted_median(side)
        stored = left if stored is None else stored
        if left * 8 < stored and left > 1 << 16:
            # Most stored keys are decided: keep the open ones only.
            fresh = cut(_open(keys, low, high), "open_keys")
            release(*([own] if own is not None else []))
            keys = own = fresh
            stored = left
    if own is not None and own is not first:
        release(own)
    return pivot


def _open(keys: DataFrame, low: Key | None, high: Key | None) -> DataFrame:
    key = F.struct("_neg", "_order", "_row")
    as_key = lambda x: F.struct(*(F.lit(v).cast("bigint").alias(c) for v, c in zip(x, ("_neg", "_order", "_row"))))
    keys = keys if low is None else keys.where(key > as_key(low))
    return keys if high is None else keys.where(key < as_key(high))


def resample(
    docs: DataFrame, target: DataFrame, *, id_col: str, text_col: str = "text", target_col: str = "text", keep: list[str],
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """The columns ``keep`` of each document with ``n_words, n_features, weight, score`` and the ``rank`` of those drawn.

    Of the documents with ``least_words`` or more, ``percent`` of a hundred are drawn.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    names = [f"k_{c}" for c in keep]
    id_ = docs[id_col]
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    order = F.coalesce(id_.cast("bigint"), F.lit(2**63 - 1)) if whole else F.when(id_.isNull(), F.lit(2**63 - 1)).otherwise(F.xxhash64(id_))
    rows = docs.select(*(docs[c].alias(n) for c, n in zip(keep, names)), order.alias("_order"), id_.isNull().alias("_last"), id_.cast("string").alias("_id"), docs[text_col].cast("string").alias("_text"))
    types = ", ".join(f"`{c}` {t}" for c, t in rows.drop("_text", "_id").dtypes)
    scored = by_batch(rows, f"{types}, n_words bigint, n_features bigint, weight bigint, score bigint", _score(shared, seed))
    # Rows that are equal in score and id are told apart by where they were written; a null id counts as the last.
    scored = cut(scored.withColumn("_row", F.monotonically_increasing_id() + F.when(F.col("_last"), F.lit(1 << 62)).otherwise(F.lit(0))), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    k = able.count() * percent // 100
    last = cut_off(able.select((-F.col("score")).alias("_neg"), "_order", "_row"), k) if k else None
    columns = [*(F.col(n).alias(c) for c, n in zip(keep, names)), "n_words", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    key = F.struct((-F.col("score")).alias("_neg"), F.col("_order"), F.col("_row"))
    limit = F.struct(*(F.lit(v).cast("bigint").alias(c) for v, c in zip(last, ("_neg", "_order", "_row"))))
    drawn = (F.col("n_words") >= least_words) & (key <= limit)
    winners = with_row_index(scored.where(drawn), [F.desc("score"), F.col("_order"), F.col("_row")], "_rank")
    return winners.select(*columns, (F.col("_rank") + 1).cast("bigint").alias("rank")).unionByName(
        scored.where(~drawn).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    )


@query("op11_resample")
def op11(spark, sf_dir):
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = resample(docs, target, id_col="doc_id", keep=["doc_id"])
    return found.select("doc_id", "n_features", "weight", "score", "rank")
