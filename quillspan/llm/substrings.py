"""Removal of word sequences that occur more than once, by anchored paths of edges of a De Bruijn graph.

Paths are not the maximal nonbranching paths of the graph: anchors (minimizers) replace the degrees of its nodes. A
path is a run of edges of one text with the same anchor, cut inside that text, and "branching" means that one anchor
has different paths. Joining edges on shared nodes would shuffle every edge of the corpus, again and again along a
path; paths by anchors shuffle a few rows a text, and opening those that differ keeps the result exact.

Edges are the k-mers of the token sequence: ``window`` consecutive words. Edges that follow each other in a
document and share their anchor (the smallest hash of a ``gram``-word gram inside the edge, the first of
equal ones) form one path, so a text of n words is about 2n / (window - gram) paths. The anchor depends on
the edge alone: all occurrences of an edge lie on paths of one anchor, wherever they are.

1. Paths are counted per anchor. An anchor with one path is nonbranching: its edges share the path's count,
   and if that is two or more the whole path is a repeated span without looking at its edges.
2. Where several paths meet at an anchor, and only there, paths are opened to single edges, which are counted.
3. Repeated spans go back to their source coordinates (document, word position), where the words are hashed
   again and compared before anything is removed; overlapping spans merge.

Joins and counts run on hashes of 128 bits together (anchor and path, anchor and edge). No group is gathered:
counts are partial sums, joins are plain equi-joins that adaptive execution may split, and the spans of a
document are bounded by its words. A bitmap of fixed size (16 MB) keeps paths of unrepeated anchors from
leaving the second scan; the joins after it are exact.

Defined results: null and empty texts have no words and are kept as empty text; a text of fewer than
``window`` words loses none; equal rows count as separate places, so all their windows are repeated; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspan.llm import words as W
from quillspan.llm.common import Bitmap, by_batch, cut
from quillspan.llm.registry import query, table

WINDOW, GRAM = 35, 8
BITMAP_BITS = 27


def _paths(words: W.Words, window: int, gram: int):
    """First word, number of edges and anchor hash of each path."""
    at = np.flatnonzero(words.inside(window))
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    grams = words.grams(gram)
    anchors = W.smallest(grams, window - gram + 1)[at]
    new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(anchors) != 0)])
    first = np.flatnonzero(new)
    return at[first], np.diff(np.concatenate([first, [len(at)]])), grams[anchors[first]]


def _count_paths(window: int, gram: int):
    def work(batch):
        for _, _, words in W.chunks(batch.column("_text"), W.SPACED):
            at, edges, anchors = _paths(words, window, gram)
            whole = words.spans(at, at + edges + window - 1)
            yield pa.RecordBatch.from_arrays([pa.array(W.signed(anchors)), pa.array(W.signed(whole))], names=["anchor", "path"])

    return work


def _repeated_paths(window: int, gram: int, repeated, branching):
    def work(batch):
        keys = batch.column("_key").to_numpy()
        for a, _, words in W.chunks(batch.column("_text"), W.SPACED):
            at, edges, anchors = _paths(words, window, gram)
            kept = repeated.value.has(anchors)
            at, edges, anchors = at[kept], edges[kept], anchors[kept]
            opened = branching.value.has(anchors)
            counts = np.where(opened, edges, 0)
            ends = np.cumsum(counts)
            each = np.repeat(at - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(W.signed(words.spans(each, each + window)))
            )
            rows = words.rows[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[a + rows]),
                    pa.array((at - words.first[rows]).astype(np.int32)),
                    pa.array((edges + window - 1).astype(np.int32)),
                    pa.array(W.signed(anchors)),
                    pa.array(W.signed(words.spans(at, at + edges + window - 1))),
                    lists,
                ],
                names=["_key", "at", "n", "anchor", "whole", "edges"],
            )

    return work


def _cut(texts: pa.Array, words: W.Words, gone: np.ndarray) -> pa.Array:
    """The texts without the bytes of the words that are gone and the white space behind each."""
    _, offsets = W.buffers(texts)
    offsets = offsets - offsets[0]
    last = np.append(words.rows[1:] != words.rows[:-1], True) if len(words.starts) else np.zeros(0, bool)
    ends = np.where(last, words.ends, np.append(words.starts[1:], 0)[: len(last)])
    depth = np.zeros(len(words.data) + 1, np.int8)
    depth[words.starts[gone]] += 1
    np.subtract.at(depth, ends[gone], 1)
    stays = np.cumsum(depth[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(stays)])[offsets]
    data = words.data[stays]
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())


def _removed(batch, in_place: bool = False):
    """The kept words of each text, after checking each span against the words at its place."""
    kept_columns = [c for c in batch.schema.names if c.startswith("k_")]
    for a, b, words in W.chunks(batch.column("_text"), W.SPACED):
        part = batch.slice(a, b - a)
        spans = part.column("spans")
        rows = np.repeat(np.arange(b - a), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        flat = spans.flatten()
        at, n, whole = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("at", "n", "whole"))
        starts = words.first[rows] + at
        ends = starts + n
        fits = ends <= words.first[rows + 1]
        starts, ends, whole = starts[fits], ends[fits], whole[fits]
        same = W.signed(words.spans(starts, ends)) == whole
        depth = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(depth, starts[same], 1)
        np.add.at(depth, ends[same], -1)
        gone = np.cumsum(depth[:-1]) > 0
        kept = np.flatnonzero(~gone)
        kept_first = np.searchsorted(kept, words.first)
        if in_place:
            left = _cut(part.column("_text"), words, gone)
        else:
            data, offsets = _joined(words, kept, kept_first)
            left = pa.Array.from_buffers(pa.large_string(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.string())
        total = np.concatenate([[0], np.cumsum(gone)])
        yield pa.RecordBatch.from_arrays(
            [
                *(part.column(c) for c in kept_columns),
                pa.array(words.counts, pa.int64()),
                pa.array(np.diff(total[words.first]), pa.int64()),
                left,
            ],
            names=[*kept_columns, "n_words", "n_removed", "kept_text"],
        )


def _joined(words: W.Words, kept: np.ndarray, first: np.ndarray):
    """Bytes of the kept words with one blank between those of a text, and the texts' offsets."""
    starts, sizes = words.starts[kept], words.ends[kept] - words.starts[kept]
    blank = np.ones(len(kept), np.int64)  # one before each word but the first of a text
    heads = first[:-1][np.diff(first) > 0]
    blank[heads] = 0
    ends = np.cumsum(sizes + blank)
    out = np.full(ends[-1] if len(ends) else 0, 0x20, np.uint8)
    to = np.repeat(ends - sizes, sizes) + _within(sizes)
    out[to] = words.data[np.repeat(starts, sizes) + _within(sizes)]
    return out, np.concatenate([[0], ends])[first].astype(np.int64)


def _within(sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    keep: list[str] | None = None,
    in_place: bool = False,
) -> DataFrame:
    """One row per document: ``keep`` (the id), ``n_words, n_removed, kept_text`` (kept words joined by one blank).

    With ``in_place``, ``kept_text`` is the text without the removed words and the white space behind each of
    them, otherwise as it was.
    """
    spark = docs.sparkSession
    keep = [id_col] if keep is None else keep
    kept = [docs[c].alias(f"k_{c}") for c in keep]
    rows = docs.select(F.xxhash64(docs[id_col], docs[text_col].cast("string")).alias("_key"), docs[text_col].cast("string").alias("_text"), *kept)
    paths = by_batch(rows.select("_text"), "anchor bigint, path bigint", _count_paths(window, gram))
    anchors = (
        paths.groupBy("anchor", "path")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("anchor")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("paths"))
        .where("n > 1")
        .select("anchor", (F.col("paths") > 1).alias("branching"))
    )
    anchors = cut(anchors, "anchors")
    repeated = spark.sparkContext.broadcast(Bitmap(anchors, "anchor", BITMAP_BITS))
    branching = spark.sparkContext.broadcast(Bitmap(anchors.where("branching"), "anchor", BITMAP_BITS))
    schema = "_key bigint, at int, n int, anchor bigint, whole bigint, edges array<bigint>"
    places = by_batch(rows.select("_key", "_text"), schema, _repeated_paths(window, gram, repeated, branching))
    places = cut(places.join(anchors, "anchor"), "places")

    settled = places.where("not branching").select("_key", "at", "n", "whole")
    edges = places.where("branching").select("_key", "at", "anchor", F.posexplode("edges").alias("i", "whole"))
    many = edges.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor", "whole")
    many = cut(many, "edges")  # so that the join reads two plain exchanges, which adaptive execution can split
    opened = edges.join(many, ["anchor", "whole"]).select("_key", (F.col("at") + F.col("i")).alias("at"), F.lit(window).alias("n"), "whole")
    spans = settled.unionByName(opened).groupBy("_key").agg(F.collect_set(F.struct("at", "n", "whole")).alias("spans"))

    types = ", ".join(f"`{c}` {t}" for c, t in rows.drop("_key", "_text").dtypes)
    done = by_batch(rows.join(spans, "_key", "left").drop("_key"), f"{types}, n_words bigint, n_removed bigint, kept_text string", lambda batch: _removed(batch, in_place))
    return done.select(*(F.col(f"k_{c}").alias(c) for c in keep), "n_words", "n_removed", "kept_text")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, s, md5(array_to_string(w[s:s + 34], ' ')) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM d)),
m AS (SELECT h FROM x GROUP BY h HAVING count(*) > 1),
c AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(s, s + 35)) AS p FROM x JOIN m USING (h)) GROUP BY r),
k AS (SELECT r, string_agg(w[p], ' ' ORDER BY p) AS t
      FROM (SELECT d.r, w, unnest(range(1, len(w) + 1)) AS p FROM d) u
      WHERE NOT EXISTS (SELECT 1 FROM (SELECT r AS r2, unnest(gone) AS g FROM c) z WHERE z.r2 = u.r AND z.g = u.p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN c USING (r) LEFT JOIN k USING (r)
"""


@query("op4_substrings", ORACLE)
def op4(spark, sf_dir):
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
