"""Positional postings of a text field: phrases and best matches without reading the texts.

One row holds what one block of documents says about one token: each document's length and the places of the token in
it, how many documents those are, the most often the token occurs in one and the length of the shortest. Blocks hold
about as much text each: documents are classed by the binary order of their length, and each class is dealt over
as many blocks as its text fills. So a long document cannot make its block slow, and documents of a block are of like
length, which keeps the bounds of their scores close.

The rows lie in a table bucketed by block and sorted by token inside each bucket: a search skips to its tokens by
Parquet statistics, and all that is known about a document is in one bucket, so tokens meet without a shuffle. Places
are stored in ascending order with Parquet's delta encoding.

Best matches take two passes. The first reads only the counts of the query's tokens, gives each block an upper bound of
its scores, scores the blocks of the highest bounds until they hold enough documents, and so learns a score that the
k-th best reaches at least; the second reads the blocks whose bound reaches it. Scores and ties are those of a scan.

Documents without an id are not indexed; ids must be unique.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan.functions import text as ta
from quillspan.functions.rows import unnest
from quillspan.operators.collection import bm25, inverse_document_frequency
from quillspan.operators.search import SCORE_DIGITS

BUCKETS = 64
BLOCK_CHARS = 1 << 20
#: About so much text is indexed by one task, which then sorts what it finds in memory.
PART_CHARS = 1 << 23
#: So many candidate blocks are named to the scan, which then skips the others' pages; more are joined.
NAMED_BLOCKS = 10_000
# Bounds are sums in another order than scores; they are lifted by more than that can differ.
_SLACK = 1e-6


@dataclass(frozen=True)
class Positions:
    rows: DataFrame
    n: int
    avgdl: float


def _table(path: str) -> str:
    return f"positions_{hashlib.md5(path.encode()).hexdigest()}"


def _blocks(df: DataFrame, id_col: str, field: str, block_chars: int) -> tuple[Column, int]:
    """The block of each document: its class by length, then its id's hash among the blocks of the class; and the size of all texts."""
    order = F.floor(F.log2(F.greatest(F.length(field), F.lit(1)))).cast("int")
    order = F.coalesce(order, F.lit(0))
    sizes = df.groupBy(order.alias("order")).agg(F.sum(F.coalesce(F.length(field), F.lit(0)) + 1).alias("chars"))
    first, counts, total, chars = {}, {}, 0, 0
    for row in sizes.orderBy("order").collect():  # lengths have 31 binary orders
        first[row["order"]], counts[row["order"]] = total, -(-row["chars"] // block_chars)
        total, chars = total + counts[row["order"]], chars + row["chars"]
    if not counts:
        return F.lit(0), 0
    as_map = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return (as_map(first)[order] + F.pmod(F.xxhash64(id_col), as_map(counts)[order])).cast("int"), chars


def _places(words: str) -> Column:
    """``array<struct<token, places>>`` of a column of ``struct<token, place>`` sorted by both."""
    at = F.col(words)
    starts = F.filter(
        F.transform(at, lambda w, i: F.when((i == 0) | (F.get(at, i - 1)["token"] != w["token"]), i)), lambda i: i.isNotNull()
    )
    ends = F.concat(F.slice(starts, F.lit(2), F.size(at)), F.array(F.size(at)))
    return F.transform(
        F.arrays_zip(starts.alias("start"), ends.alias("end")),
        lambda r: F.struct(
            F.get(at, r["start"])["token"].alias("token"),
            F.transform(F.slice(at, r["start"] + 1, r["end"] - r["start"]), lambda w: w["place"]).alias("places"),
        ),
    )


def write_positions(
    df: DataFrame, id_col: str, field: str, path: str, buckets: int = BUCKETS, block_chars: int = BLOCK_CHARS
) -> None:
    """Shuffle the texts once to their blocks' tasks, then find the places of every token there.

    Texts are smaller than their places. A bucket is dealt over as many tasks as its text fills, each of which writes a file of
    its own: their number is a multiple of ``buckets``, so a task's blocks share a bucket. ``path`` must be absolute. The places of one token in one block are one row, bounded by ``block_chars`` or, where
    one document is longer, by that document.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("_id"), F.col(field).cast("string").alias("_text"))
    block, chars = _blocks(docs, "_id", "_text", block_chars)
    tasks = buckets * max(1, -(-chars // (buckets * PART_CHARS)))
    dealt = docs.where(F.col("_id").isNotNull()).select("_id", "_text", block.alias("block")).repartition(tasks, "block")
    words = dealt.select("_id", "block", ta.tokens(F.col("_text")).alias("_words"))
    placed = F.sort_array(F.transform("_words", lambda w, i: F.struct(w.alias("token"), i.alias("place"))))
    words = words.select("_id", "block", F.size("_words").alias("dl"), placed.alias("_sorted"))
    found = words.select("_id", "block", "dl", F.when(F.col("dl") > 0, _places("_sorted")).alias("_found"))
    rows = unnest(found, "_found", "_f").select("block", "_f.token", F.struct("_id", "dl", F.size("_f.places").alias("tf"), "_f.places").alias("doc"))
    rows = rows.groupBy("block", "token").agg(
        F.collect_list("doc").alias("docs"),
        F.count(F.lit(1)).alias("df"),
        F.sum("doc.tf").alias("cf"),
        F.max("doc.tf").alias("most"),
        F.min("doc.dl").alias("shortest"),
    )
    name = f"{_table(path)}_new"
    writer = rows.write.format("parquet").bucketBy(buckets, "block").sortBy("token", "block").option("path", f"{path}/rows")
    writer = writer.option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary#docs.list.element.places.list.element", "false")
    writer.saveAsTable(name)
    # Documents without tokens are in no row, but they count.
    words_in_all = spark.table(name).agg(F.coalesce(F.sum("cf"), F.lit(0))).scalar()
    totals = docs.agg(F.count(F.lit(1)).alias("n")).select("n", (words_in_all / F.greatest("n", F.lit(1))).alias("avgdl"), F.lit(buckets).alias("buckets"))
    columns = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in rows.schema)
    totals = totals.withColumn("columns", F.lit(columns))
    totals.write.parquet(f"{path}/totals")
    spark.sql(f"DROP TABLE {name}")  # its files stay


def read_positions(spark: SparkSession, path: str) -> Positions:
    """The postings under ``path``, as a bucketed table of this session."""
    totals = spark.read.parquet(f"{path}/totals").first()
    name = _table(path)
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({totals['columns']}) USING parquet CLUSTERED BY (block) SORTED BY (token, block) "
            f"INTO {totals['buckets']} BUCKETS LOCATION '{path}/rows'"
        )
    return Positions(spark.table(name), totals["n"], totals["avgdl"])


def _frequencies(index: Positions, wanted: list[str]) -> dict[str, int]:
    """In how many documents each token is, from the counts alone."""
    counts = index.rows.where(F.col("token").isin(wanted)).groupBy("token").agg(F.sum("df").alias("df"))
    return {r["token"]: r["df"] for r in counts.collect()}  # one row for each token of the query


def _weights(index: Positions, wanted: list[str]) -> list[Column]:
    held = _frequencies(index, wanted)
    return [inverse_document_frequency(F.lit(index.n), F.lit(held.get(t, 0))) for t in wanted]


def _documents(rows: DataFrame, wanted: list[str], places: bool = False, prefix: str | None = None) -> DataFrame:
    """One row per document: its length and how often it has each token (NULL if never); with ``places``, where.

    Rows of a document are in its block's bucket, so Spark groups them where they are read.
    """
    # Zipped from its parts, so that the scan reads the parts that are used.
    parts = ["_id", "dl", "tf", *(["places"] if places or prefix is not None else [])]
    docs = rows.select("block", "token", F.explode(F.arrays_zip(*[F.col(f"docs.{c}").alias(c) for c in parts])).alias("d"))
    of = lambda t, c: F.max(F.when(F.col("token") == t, F.col(f"d.{c}")))
    held = [of(t, "tf").alias(f"tf{i}") for i, t in enumerate(wanted)]
    if places:
        held += [of(t, "places").alias(f"at{i}") for i, t in enumerate(wanted)]
    if prefix is not None:
        begun = F.collect_list(F.when(F.startswith("token", F.lit(prefix)), F.col("d.places")))
        held.append(F.flatten(begun).alias("begun"))
    return docs.groupBy("block", F.col("d._id").alias("_id")).agg(F.max("d.dl").cast("double").alias("dl"), *held)


def _scored(index: Positions, weights: list[Column]) -> Column:
    score = F.lit(0.0)
    for i, idf in enumerate(weights):
        score = score + bm25(F.coalesce(F.col(f"tf{i}"), F.lit(0)).cast("double"), F.col("dl"), idf, F.lit(index.avgdl))
    return F.round(score, SCORE_DIGITS)


def _found(wanted: list[str], operator: str) -> Column:
    held = [F.col(f"tf{i}").isNotNull() for i in range(len(wanted))]
    if operator not in ("or", "and"):
        raise ValueError(f"unknown operator {operator!r}")
    out = held[0]
    for h in held[1:]:
        out = (out | h) if operator == "or" else (out & h)
    return out


def _nothing(index: Positions) -> DataFrame:
    docs = index.rows.select(F.explode("docs").alias("d")).select("d._id", F.lit(0.0).alias("score"))
    return docs.limit(0)


def match_positions(index: Positions, text: str, operator: str = "or") -> DataFrame:
    """``_id, score`` of all documents that match ``text``, with the scores of a scan."""
    wanted = ta.distinct_in_order(ta.query_tokens(text))
    if not wanted:
        return _nothing(index)
    docs = _documents(index.rows.where(F.col("token").isin(wanted)), wanted).where(_found(wanted, operator))
    return docs.select("_id", _scored(index, _weights(index, wanted)).alias("score"))


def phrase_positions(index: Positions, text: str, last_is_prefix: bool = False) -> DataFrame:
    """``_id, score`` of the documents where the tokens of ``text`` are neighbours; the last may stand for what it begins.

    Each step keeps the places behind which the next token stands; scores are those of the phrase clauses.
    """
    wanted = ta.query_tokens(text)
    if not wanted:
        return _nothing(index)
    run, prefix = (wanted[:-1], wanted[-1]) if last_is_prefix else (wanted, None)
    whole = ta.distinct_in_order(run)
    asked = F.col("token").isin(whole) if whole else F.lit(False)
    if prefix is not None:
        asked = asked | F.startswith("token", F.lit(prefix))
    docs = _documents(index.rows.where(asked), whole, True, prefix)
    steps = [F.col(f"at{whole.index(t)}") for t in run] + ([F.col("begun")] if prefix is not None else [])
    for i in range(len(whole)):
        docs = docs.where(F.col(f"at{i}").isNotNull())
    at = steps[0]
    for step in steps[1:]:
        at = F.array_intersect(F.transform(at, lambda p: p + 1), step)
    docs = docs.where(F.size(at) > 0)
    score = _scored(index, _weights(index, whole)) if whole else F.lit(1.0)
    return docs.select("_id", score.alias("score"))


def _bounds(index: Positions, wanted: list[str], weights: list[Column], operator: str) -> DataFrame:
    """``block, bound, least`` of the blocks that hold matching documents: no score is higher, at least so many match."""
    rows = index.rows.where(F.col("token").isin(wanted)).select("block", "token", "df", "most", "shortest")
    idf = F.create_map(*[x for t, w in zip(wanted, weights) for x in (F.lit(t), w)])[F.col("token")]
    worth = bm25(F.col("most").cast("double"), F.col("shortest").cast("double"), idf, F.lit(index.avgdl))
    blocks = rows.groupBy("block").agg((F.sum(worth) + _SLACK).alias("bound"), F.count(F.lit(1)).alias("held"), F.max("df").alias("least"))
    return blocks if operator == "or" else blocks.where(F.col("held") == len(wanted)).withColumn("least", F.lit(1))


def top_blocks(index: Positions, text: str, k: int, operator: str = "or") -> DataFrame:
    """``block, bound, held, least`` of the blocks that can hold one of the ``k`` best matches."""
    wanted = ta.distinct_in_order(ta.query_tokens(text))
    weights = _weights(index, wanted)
    bounds = _bounds(index, wanted, weights, operator)
    highest = bounds.orderBy(F.desc("bound"), "block").limit(k).collect()  # each has a match or more, so k are enough
    first, matches = [], 0
    for row in highest:
        first.append(row["block"])
        matches += row["least"]
        if matches >= k:
            break
    rows = index.rows.where(F.col("token").isin(wanted) & F.col("block").isin(first))
    seen = _best(index, rows, wanted, weights, k, operator).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).first()
    return bounds.where(F.col("bound") >= F.lit(seen["least"])) if seen["n"] == k else bounds


def _best(index: Positions, rows: DataFrame, wanted: list[str], weights: list[Column], k: int, operator: str) -> DataFrame:
    docs = _documents(rows, wanted).where(_found(wanted, operator))
    return docs.select("_id", _scored(index, weights).alias("score")).orderBy(F.desc("score"), "_id").limit(k)


def top_positions(index: Positions, text: str, k: int, operator: str = "or") -> DataFrame:
    """``_id, score`` of the ``k`` best matches, ties by the smaller id, reading the blocks that can hold one."""
    wanted = ta.distinct_in_order(ta.query_tokens(text))
    if not wanted or k < 1:
        return _nothing(index)
    blocks = top_blocks(index, text, k, operator).select("block")
    named = [r["block"] for r in blocks.limit(NAMED_BLOCKS + 1).collect()]
    rows = index.rows.where(F.col("token").isin(wanted))
    rows = rows.where(F.col("block").isin(named)) if len(named) <= NAMED_BLOCKS else rows.join(blocks, "block", "left_semi")
    return _best(index, rows, wanted, _weights(index, wanted), k, operator)
