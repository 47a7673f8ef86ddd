"""Benchmark decontamination by winnowing.

Every window of ``window`` words is filed under its fingerprint: the smallest hash among the ``gram``-word
grams inside it (the first of equal ones). A document and a benchmark item that share a window of words pick
the same fingerprint inside it, so joining on fingerprints finds every shared span of at least ``window``
words; a join on the window itself then extends the hit to the words it covers.

Nothing is broadcast but a bitmap of fixed size (2 MB) of the benchmark's fingerprints. It keeps most
windows of clean text from leaving the scan; what passes is joined exactly, so a large benchmark only makes
the bitmap let more rows through.

Defined results: null and empty texts have no words; an item without words is never found; an item of fewer
than ``window`` words is one window of its own length; repeated documents are judged one by one, repeated
item ids count once, a null item id is the empty text; empty tables give no rows or no hits; other columns
of either table are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quillspan.llm import words as W
from quillspan.llm.common import Bitmap, by_batch, cut, one_text
from quillspan.llm.registry import query, table

WINDOW, GRAM = 10, 4
BITMAP_BITS = 24

_FOUND = "array<struct<print:bigint,window:bigint,n:int,at:int>>"
_STRUCT = [("print", pa.int64()), ("window", pa.int64()), ("n", pa.int32()), ("at", pa.int32())]


def _windows(words: W.Words, window: int, gram: int, short: list[int], keep=None):
    """Windows of all rows as ``(row, print, window, n, at)`` arrays; ``keep`` tests fingerprints."""
    parts = []
    for n in [window, *short]:
        at = np.flatnonzero(words.inside(n))
        whole = words.grams(n)
        if n == window:
            grams = words.grams(gram)
            prints = grams[W.smallest(grams, window - gram + 1)[at]] if len(at) else grams[:0]
        else:
            prints = whole[at]
        if keep is not None:
            chosen = keep(prints)
            at, prints = at[chosen], prints[chosen]
        rows = words.rows[at]
        parts.append((rows, prints, W.mix(whole[at]), np.full(len(at), n), at - words.first[rows]))
    joined = [np.concatenate(x) for x in zip(*parts)]
    order = np.argsort(joined[0], kind="stable")
    return [x[order] for x in joined]


def _scan(df: DataFrame, columns: list[str], window: int, gram: int, shorts, bitmap) -> DataFrame:
    """``columns``, ``n_words`` and the windows that may occur on the other side, one row per text."""
    kept = df.select(*columns).schema
    schema = T.StructType([*kept.fields, T.StructField("n_words", T.LongType()), T.StructField("found", T._parse_datatype_string(_FOUND))])

    def work(batch):
        short = shorts.value if bitmap is not None else None
        bits = bitmap.value if bitmap is not None else None
        for a, b, words in W.chunks(batch.column("_text"), W.ALNUM_FOLDED):
            if bits is not None:
                rows, prints, whole, n, at = _windows(words, window, gram, short, bits.has)
            else:  # the benchmark: texts shorter than a window are windows of their own length
                parts = [_windows(words, window, gram, [])]
                for size in range(1, window):
                    fits = words.counts == size
                    if fits.any():
                        first = words.first[:-1][fits]
                        whole = words.grams(size)[first]
                        parts.append([np.flatnonzero(fits), whole, W.mix(whole), np.full(len(first), size), np.zeros(len(first), np.int64)])
                rows, prints, whole, n, at = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(rows, kind="stable")
                rows, prints, whole, n, at = (x[order] for x in (rows, prints, whole, n, at))
            arrays = [W.signed(prints), W.signed(whole), n.astype(np.int32), at.astype(np.int32)]
            found = pa.StructArray.from_arrays([pa.array(x, t) for x, (_, t) in zip(arrays, _STRUCT)], [k for k, _ in _STRUCT])
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.array(words.counts, pa.int64()), W.ragged(found, rows, b - a)],
                names=[*columns, "n_words", "found"],
            )

    return by_batch(df.select(*columns, "_text"), schema, work)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``keep`` (the id), ``n_words, n_hit, n_items, items, spans, contaminated``.

    ``items`` lists the ids (as text, sorted) of the items with a window in the document, ``spans`` the hit
    runs of words as ``start`` and ``end`` (exclusive) word positions.
    """
    spark = docs.sparkSession
    bench = one_text(items, item_id_col, item_text_col).select(F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("_id"), "_text")
    bench = cut(
        _scan(bench, ["_id"], window, gram, None, None)
        .select("_id", F.inline("found"))
        .select(F.col("_id").alias("item"), "print", "window", "n")
        .distinct(),
        "bench",
    )
    shorts = [r[0] for r in bench.where(F.col("n") < window).select("n").distinct().collect()]  # below ``window``
    sc = spark.sparkContext
    shared_shorts, shared_bits = sc.broadcast(sorted(shorts)), sc.broadcast(Bitmap(bench, "print", BITMAP_BITS))

    keep = [id_col] if keep is None else keep
    kept = [f"k_{c}" for c in keep]
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *(docs[c].alias(k) for c, k in zip(keep, kept)), docs[text_col].cast("string").alias("_text"))
    base = cut(_scan(rows, ["_row", *kept], window, gram, shared_shorts, shared_bits), "windows")

    found = base.where(F.size("found") > 0).select("_row", F.inline("found")).join(bench, ["print", "window", "n"])
    spans = F.array_sort(F.collect_set(F.struct(F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("end"))))
    hits = found.groupBy("_row").agg(F.array_sort(F.collect_set("item")).alias("items"), spans.alias("all"))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    merged = F.aggregate(
        "all",
        empty,
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    hits = hits.select("_row", "items", merged.alias("spans"))
    none = F.array().cast("array<string>")
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return (
        base.select("_row", *kept, "n_words")
        .join(hits, "_row", "left")
        .select(*kept, "n_words", F.coalesce("items", none).alias("items"), F.coalesce("spans", empty).alias("spans"))
        .select(
            *(F.col(k).alias(c) for c, k in zip(keep, kept)),
            "n_words",
            covered.alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            "items",
            "spans",
            (F.size("spans") > 0).alias("contaminated"),
        )
    )


_WORDS_SQL = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = rf"""
WITH i AS (SELECT item_id, w, len(w) AS n FROM (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, least(n, 10) AS n, array_to_string(w[s:s + least(n, 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, n, unnest(range(1, n - least(n, 10) + 2)) AS s FROM i)),
d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
dw AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, l.n, unnest(range(1, len(w) - l.n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) l)),
h AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY 1),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(xs, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@query("op9_decontaminate", ORACLE)
def op9(spark, sf_dir):
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )
