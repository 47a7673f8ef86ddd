"""Near-duplicate classes by improved consistent weighted sampling.

A text is the weighted set of its ``shingle``-word shingles, weighted by TF-IDF: the count in the text times
``1 + IDF_SHARE * ln((N + 1) / (df + 1))``. Document frequencies are counted over all documents in 2 ** 18 hashed
features (a table of fixed size). A feature sums the shingles that share it, and saturates as the corpus grows: at 30 GB
shingles in less than about a thousandth of the texts have nearly one weight, so the weighting is close to plain
weighted Jaccard there, and only very frequent shingles weigh less. The share keeps the weight of
words that a large group of copies has in common near that of their edits, which the group itself would
otherwise outweigh.

Improved consistent weighted sampling draws ``bands * rows`` samples per text such that two texts agree on a
sample with the probability of their weighted Jaccard similarity. Texts that agree on a whole band are
candidates: at similarity 0.8, 12 bands of 3 rows miss a pair with probability 0.0002.

Candidates are not expanded into all pairs. Exact copies are one text from the start. In each bucket every
text is first compared with one pivot, the text that meets most others; texts found similar are one component.
Texts that this leaves outside a bucket's largest component are then joined exactly with all others, by their
rarest shingles, so no link between components is left out. All candidates are verified by the exact weighted
Jaccard similarity of their whole texts.

Defined results: null and empty texts, and texts without words, have no shingles and are classes of their own;
a text of fewer words than a shingle is one shingle; equal texts are one class, repeated rows included; a row
whose id is null takes part and its class is named by the least id that is not null; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspan.llm import words as W
from quillspan.llm.common import Bitmap, by_batch, cut, one_text
from quillspan.llm.components import components
from quillspan.llm.registry import query, table

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 12, 3
FEATURE_BITS, IDF_SHARE = 18, 0.02
_ID_BITS, _POOL_BITS = 48, 18


def shingles(words: W.Words, size: int):
    """``row, id, count`` of the distinct shingles of each text, by row; ids are 48-bit hashes."""
    at = np.flatnonzero(words.inside(size))
    ids, rows = words.grams(size)[at], words.rows[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        ids = np.concatenate([ids, words.spans(words.first[short], words.first[short + 1])])
        rows = np.concatenate([rows, short])
    keys = np.sort((rows.astype(np.uint64) << np.uint64(_ID_BITS)) | (ids >> np.uint64(64 - _ID_BITS)))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([first, [len(keys)]]))
    keys = keys[first]
    return (keys >> np.uint64(_ID_BITS)).astype(np.int64), keys & np.uint64((1 << _ID_BITS) - 1), counts


def _features(ids: np.ndarray) -> np.ndarray:
    return (ids >> np.uint64(_ID_BITS - FEATURE_BITS)).astype(np.int64)


def _pool():
    """Random draws of the sampling: a shingle looks its own up by a hash of its id, another for each sample."""
    rng = np.random.default_rng(20_250_101)
    n = 1 << _POOL_BITS
    r = rng.gamma(2.0, 1.0, n).astype(np.float32)
    return r, (1 / r).astype(np.float32), rng.uniform(0, 1, n).astype(np.float32), np.log(rng.gamma(2.0, 1.0, n)).astype(np.float32)


_POOL: list = []


def samples(rows: np.ndarray, ids: np.ndarray, weights: np.ndarray, n_samples: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have shingles, and for each a row of 64-bit samples."""
    if not _POOL:
        _POOL.append(_pool())
    r_of, inverse_of, beta_of, ln_c_of = _POOL[0]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.zeros(0, np.int64)
    out = np.empty((len(first), n_samples), np.uint64)
    if not len(first):
        return first, out
    sizes = np.diff(np.concatenate([first, [len(rows)]]))
    group = np.repeat(np.arange(len(first)), sizes)
    ln_w = np.log(weights).astype(np.float32)
    for k in range(n_samples):
        odd = W.mix(np.array([2 * k + 1], np.uint64))[0] | np.uint64(1)
        at = ((ids * odd) >> np.uint64(64 - _POOL_BITS)).astype(np.int64)
        r, beta = r_of[at], beta_of[at]
        t = np.floor(ln_w * inverse_of[at] + beta)
        ln_a = ln_c_of[at] - r * (t - beta + np.float32(1))
        least = np.minimum.reduceat(ln_a, first)
        won = np.flatnonzero(ln_a == least[group])
        _, lead = np.unique(group[won], return_index=True)
        won = won[lead]
        out[:, k] = W.mix(W.mix(ids[won] + np.uint64(k)) ^ t[won].astype(np.int64).astype(np.uint64))
    return rows[first], out


def _count_features(shingle: int):
    def run(batches):
        counts, n = np.zeros(1 << FEATURE_BITS, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, words in W.chunks(batch.column("_text"), W.SPACED):
                counts += np.bincount(_features(shingles(words, shingle)[1]), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(counts[at], n))], names=["feature", "n"]
        )

    return run


def feature_weights(rows: DataFrame, shingle: int) -> np.ndarray:
    """The weight of one occurrence of each hashed feature: 2 ** FEATURE_BITS numbers, whatever the corpus."""
    counted = rows.select("_text").mapInArrow(_count_features(shingle), "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    at, n = counted["feature"].to_numpy(), counted["n"].to_numpy()
    total = n[at < 0].sum()
    df = np.zeros(1 << FEATURE_BITS)
    df[at[at >= 0]] = n[at >= 0]
    return 1 + IDF_SHARE * np.maximum(0, np.log((total + 1) / (df + 1)))


def _sketch(shingle: int, bands: int, per_band: int, weights):
    def work(batch):
        for a, b, words in W.chunks(batch.column("_text"), W.SPACED):
            rows, ids, counts = shingles(words, shingle)
            rows, drawn = samples(rows, ids, counts * weights.value[_features(ids)], bands * per_band)
            keys = np.zeros((len(rows), bands), np.uint64)
            for i in range(per_band):
                keys = W.mix(keys + drawn[:, i::per_band])
            keys = W.mix(keys + np.arange(bands, dtype=np.uint64))
            part = batch.slice(a, b - a).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_text_id"),
                    part.column("_id"),
                    pa.FixedSizeListArray.from_arrays(pa.array(W.signed(keys.reshape(-1))), bands).cast(pa.list_(pa.int64())),
                ],
                names=["text_id", "id", "keys"],
            )

    return work


def _similar(shingle: int, least: float, weights):
    def work(batch):
        data = [W.buffers(batch.column(c)) for c in ("text_a", "text_b")]
        n, at = batch.num_rows, 0
        sizes = np.cumsum(sum(np.diff(offsets) for _, offsets in data))
        while at < n:
            done = sizes[at - 1] if at else 0
            to = min(max(at + 1, int(np.searchsorted(sizes, done + W.CHUNK))), at + W.CHUNK_ROWS, n)
            sets = []
            for buffer, offsets in data:
                rows, ids, counts = shingles(W.of_bytes(buffer, offsets[at : to + 1], W.SPACED), shingle)
                w = counts * weights.value[_features(ids)]
                sets.append(((rows.astype(np.uint64) << np.uint64(_ID_BITS)) | ids, w, np.bincount(rows, w, to - at)))
            (a, wa, sum_a), (b, wb, sum_b) = sets
            both, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
            shared = np.bincount((both >> np.uint64(_ID_BITS)).astype(np.int64), np.minimum(wa[in_a], wb[in_b]), to - at)
            part = batch.slice(at, to - at)
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(shared / (sum_a + sum_b - shared))], names=["a", "b", "similarity"]
            ).filter(pa.array(shared >= least * (sum_a + sum_b - shared)))
            at = to

    return work


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows_per_band: int = ROWS,
) -> DataFrame:
    """One row per document: ``id_col, text_md5, class_id, n_texts, kept``.

    ``class_id`` is the least id of the class, ``n_texts`` the number of different texts in it, ``kept`` is true
    for one row of each class.
    """
    spark = docs.sparkSession
    rows = one_text(docs, id_col, text_col).withColumn("_text_id", F.unhex(F.md5("_text")))
    weights = spark.sparkContext.broadcast(feature_weights(rows, shingle))
    id_type = rows.schema["_id"].dataType.simpleString()

    sketch = _sketch(shingle, bands, rows_per_band, weights)
    drawn = by_batch(rows, f"text_id binary, id {id_type}, keys array<bigint>", sketch)
    # One row per different text, with a number of its own; equal texts have equal samples.
    texts = drawn.groupBy("text_id").agg(F.min("id").alias("id"), F.first("keys").alias("keys"))
    texts = cut(texts.withColumn("node", F.monotonically_increasing_id()), "texts")

    members = texts.select("node", F.explode("keys").alias("key"))
    shared = cut(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    buckets = cut(members.join(shared, "key"), "buckets")
    # The text that meets most others stands in the middle of its group: it is the bucket's pivot.
    degrees = cut(buckets.groupBy("node").agg(F.sum("n").alias("degree")), "degrees")
    buckets = cut(buckets.join(degrees, "node").select("key", "node", "degree"), "buckets")
    pivots = cut(buckets.groupBy("key").agg(F.max_by("node", F.struct("degree", "node")).alias("pivot")), "pivots")
    stars = buckets.join(pivots, "key").where("node <> pivot")
    stars = cut(stars.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct(), "pairs")

    # The texts of all candidates, once each: the row of the least id stands for its copies.
    wanted = cut(buckets.select("node").distinct().join(texts, "node").select("node", "text_id", "id"), "wanted")
    once = rows.join(wanted.hint("merge"), (F.col("_text_id") == F.col("text_id")) & F.col("_id").eqNullSafe(F.col("id")))
    held = cut(once.groupBy("node").agg(F.first("_text").alias("text")), "held")

    def verified(pairs):
        with_a = pairs.hint("merge").join(held.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        with_both = with_a.hint("merge").join(held.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        return cut(by_batch(with_both, "a bigint, b bigint, similarity double", _similar(shingle, similarity, weights)), "links")

    links = verified(stars).select("a", "b")
    labels = cut(components(links), "labels")
    links = links.unionByName(verified(_strays(held, buckets, labels, shingle, similarity, weights)).select("a", "b"))
    labels = cut(components(links), "labels")

    named = texts.select("node", "text_id", "id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = cut(named, "named")
    classes = named.groupBy("label").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_texts"))
    named = cut(named.join(classes, "label").select("text_id", "class_id", "n_texts", "label"), "classes")

    every = rows.select("_id", "_text_id", F.monotonically_increasing_id().alias("_row"))
    every = cut(every.join(named.withColumnRenamed("text_id", "_text_id"), "_text_id", "left"), "rows")
    first = every.where("label is not null").groupBy("label").agg(F.min(F.struct("_id", "_row")).alias("first"))
    first = cut(first.select("first._row", F.lit(True).alias("kept")), "kept")
    return every.join(first, "_row", "left").select(
        F.col("_id").alias(id_col),
        F.lower(F.hex("_text_id")).alias("text_md5"),
        F.coalesce("class_id", "_id").alias("class_id"),
        F.coalesce("n_texts", F.lit(1)).cast("long").alias("n_texts"),
        (F.col("kept").isNotNull() | F.col("label").isNull()).alias("kept"),
    )


def _prefixes(shingle: int, least: float, weights, mixed):
    """Each text's rarest shingles: those from which on it still has the weight that a similar text must share."""

    def work(batch):
        batch = batch.filter(pa.array(mixed.value.has(batch.column("hash").to_numpy().view(np.uint64))))
        nodes = batch.column("node").to_numpy()
        for a, b, words in W.chunks(batch.column("text"), W.SPACED):
            rows, ids, counts = shingles(words, shingle)
            one = weights.value[_features(ids)]
            order = np.lexsort((ids, -one, rows))
            rows, ids, w = rows[order], ids[order], (counts * one)[order]
            total = np.bincount(rows, w, b - a)
            before = np.cumsum(w) - w
            first = np.searchsorted(rows, np.arange(b - a))
            start = before[np.minimum(first, max(0, len(w) - 1))] if len(w) else np.zeros(b - a)
            rest = total[rows] - (before - start[rows])
            kept = rest >= least * total[rows] - 1e-6
            rows, ids, rest = rows[kept], ids[kept], rest[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.astype(np.int64)), pa.array(nodes[a + rows]), pa.array(rest), pa.array(total[rows])],
                names=["id", "node", "rest", "total"],
            )

    return work


def _strays(held: DataFrame, buckets: DataFrame, labels: DataFrame, shingle: int, least: float, weights) -> DataFrame:
    """Candidates that no star has linked: texts outside the largest component of a bucket, with any others.

    Two similar texts share one of their rarest shingles (prefix filtering over one order of all shingles, which
    is exact), and what follows it must weigh enough in both. The shingles that a large group has in common come
    last in that order, so its members don't meet in them.
    """
    known = cut(buckets.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label")), "known")
    sizes = known.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("k"))
    main = cut(main.where("k > 1").select("key", "main"), "main")
    nodes = known.join(main, "key").groupBy("node").agg(F.max("label").alias("label"), F.max(F.col("label") != F.col("main")).alias("stray"))
    nodes = cut(nodes.withColumn("hash", F.xxhash64("node")), "mixed")
    mixed = held.sparkSession.sparkContext.broadcast(Bitmap(nodes, "hash", 24))
    rows = by_batch(
        held.select("node", "text", F.xxhash64("node").alias("hash")),
        "id bigint, node bigint, rest double, total double",
        _prefixes(shingle, least, weights, mixed),
    )
    rows = cut(rows.join(nodes.select("node", "label", "stray"), "node"), "prefixes")
    x = rows.where(F.col("rest") >= 2 * least / (1 + least) * F.col("total") - 1e-6).alias("x")
    y = rows.alias("y")
    rule = (
        (F.col("x.id") == F.col("y.id"))
        & (F.col("x.label") != F.col("y.label"))
        & (F.col("x.stray") | F.col("y.stray"))
        & ((F.col("x.total") < F.col("y.total")) | ((F.col("x.total") == F.col("y.total")) & (F.col("x.node") < F.col("y.node"))))
        & (F.least("x.rest", "y.rest") * (1 + least) >= least * (F.col("x.total") + F.col("y.total")) - 1e-6)
    )
    pairs = x.join(y, rule).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    return cut(pairs.distinct(), "strays")


@query("op10_near_duplicates")
def op10(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_md5")
