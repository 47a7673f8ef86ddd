"""The corpus pipeline over ``documents``: five stages, each over all that its predecessor kept.

1. language: documents whose text no learned language explains are dropped; a missing ``lang`` is filled in.
2. near_duplicates: one document of each class of near-duplicates stays.
3. substrings: words of repeated sequences leave the texts, which otherwise stay as they are; ``n_chars`` follows.
4. decontamination: documents that hold a window of a benchmark item are dropped.
5. mixing: documents are drawn so that sources, languages and kinds of text near their targets.

The first four return the columns of ``documents``; the last adds what it has decided. SQL can't express the
models of the first two stages, so tests hold the stages against brute force instead.

Defined results of all stages: columns beside those of ``documents`` are kept, whatever their names (what the last stage adds is
called ``mixing_<name>`` where the name is taken); an empty table gives an empty one; a null id is kept and passed on. Null
and empty texts have no language, so the first stage drops them; given to a later one, the second keeps one document for each null
or empty text and id as the classes say, the third gives them an empty text, the fourth keeps them as they are, the last draws them by their cell's
probability. Of rows that are equal in id and text the second stage keeps one, the first by the text of their other columns; ties
between documents of a class go to the smaller id. Repeated rows given to a later stage are treated alike.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillspan.llm.common import cut
from quillspan.llm.decontaminate import decontaminate
from quillspan.llm.language import identify, train
from quillspan.llm.mixing import mix, topic
from quillspan.llm.neardup import near_duplicates
from quillspan.llm.substrings import remove_repeats
from quillspan.plans.durable import release

#: The share of all tokens that the last stage draws, and how far it flattens the present shares.
BUDGET_SHARE, POWER = 0.9, 0.9
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(work: Callable) -> Callable:
    """Give all other columns names of our own while a stage works."""

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        inner = [c if c in COLUMNS and names.index(c) == i else f"extra_{i}" for i, c in enumerate(names)]
        done = work(spark, docs.toDF(*inner), sf_dir)
        added = [c for c in done.columns if c not in inner]
        taken = {c.lower() for c in names}
        return done.select(*inner, *added).toDF(*names, *(f"mixing_{c}" if c.lower() in taken else c for c in added))

    return run


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = identify(docs, train(docs), keep=docs.columns)
    lang = F.coalesce("lang", "lang_pred").alias("lang")
    return found.where("not rejected").select(*(lang if c == "lang" else c for c in docs.columns))


@stage
def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = cut(near_duplicates(docs), "classes")
    kept = found.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_md5"))
    left = docs.join(kept.hint("merge"), docs["doc_id"].eqNullSafe(F.col("_id")) & F.md5(docs["text"]).eqNullSafe(F.col("_md5")), "left_semi")
    # A row that occurs twice as it is matches its own kept twin; only then are rows compared whole.
    again = found.groupBy("doc_id", "text_md5").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if again.isEmpty():
        return left
    others = F.struct(*(c for c in docs.columns if c not in ("doc_id", "text")))
    first = left.groupBy("doc_id", "text").agg(F.min_by(others, F.to_json(others)).alias("_others"))
    return first.select("doc_id", "text", "_others.*").select(*docs.columns)


@stage
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = remove_repeats(docs, keep=[c for c in docs.columns if c not in ("text", "n_chars")], in_place=True)
    done = done.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("long"))
    return done.select(*docs.columns)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = docs.withColumn("_md5", F.md5("text"))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(marked, items, keep=["doc_id", "_md5"]).where("contaminated")
    found = cut(found.select(F.col("doc_id").alias("_id"), F.col("_md5").alias("_digest")), "contaminated")
    same = marked["doc_id"].eqNullSafe(F.col("_id")) & marked["_md5"].eqNullSafe(F.col("_digest"))
    return marked.join(found, same, "left_anti").select(*docs.columns)


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dimensions = {"source": docs["source"], "lang": docs["lang"], "topic": topic(docs["text"])}
    mixed = mix(docs, dimensions, power=POWER, budget_share=BUDGET_SHARE, keep=docs.columns)
    return mixed.where("sampled").select(*(F.col(c) for c in docs.columns), "n_tokens", F.col("in_topic").alias("topic"), "probability")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicate),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        before, docs = docs, cut(work(spark, docs, sf_dir), name)
        release(before)  # nothing for the table itself
    return STAGES[-1][1](spark, docs, sf_dir)
