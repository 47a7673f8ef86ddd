"""Many standing queries at once: each document finds the queries that it matches.

Queries are rows. Each asks for terms that a document must have (tokens of text fields, values of other fields), terms that
it must not have, and ranges of numbers. A query is indexed by the rarest of its required terms, rarest among all
queries, so that terms every query asks for find none of them. A document's terms meet that index in one equi-join that
gives candidates; these alone are checked in full. So one plan serves any number of queries, and its work follows
the documents and their candidates, not the product of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspan.functions import text as ta
from quillspan.functions.fields import field_column, is_array

#: ``ranges`` include ``low`` and exclude ``high``; NULL leaves a side open.
QUERY_SCHEMA = (
    "query_id string, required array<struct<field:string,value:string>>, excluded array<struct<field:string,value:string>>, "
    "ranges array<struct<field:string,low:double,high:double>>"
)
_SEP = "\u0001"


def _key(term: Column) -> Column:
    return F.concat(term["field"], F.lit(_SEP), term["value"])


def _terms(docs: DataFrame, text_fields: list[str], value_fields: list[str]) -> Column:
    """All different terms of a document as ``field<sep>value``."""

    def of(field: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.concat(F.lit(field + _SEP), v))

    parts = [of(field, ta.tokens(field_column(docs, field))) for field in text_fields]
    for field in value_fields:
        value = field_column(docs, field)
        values = value.cast("array<string>") if is_array(docs, field) else F.array(value.cast("string"))
        parts.append(of(field, F.coalesce(values, F.array().cast("array<string>"))))
    return F.array_distinct(F.array_compact(F.concat(*parts)))


def indexed(queries: DataFrame) -> DataFrame:
    """The queries with ``anchor``, the required term that the fewest queries ask for (the first of equal ones)."""
    required = F.array_distinct(F.transform("required", _key))
    keyed = queries.select("query_id", required.alias("required"), F.transform("excluded", _key).alias("excluded"), "ranges")
    asked = keyed.select("query_id", F.explode("required").alias("term"))
    counts = asked.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    anchors = asked.join(counts, "term").groupBy("query_id").agg(F.min(F.struct("n", "term"))["term"].alias("anchor"))
    return keyed.join(anchors, "query_id")


def percolate(
    docs: DataFrame, queries: DataFrame, id_col: str, text_fields: list[str] = (), value_fields: list[str] = (), number_fields: list[str] = ()
) -> DataFrame:
    """``<id_col>, query_id`` of every document and query that matches it.

    ``queries`` has :data:`QUERY_SCHEMA`, its ids unique; a query without a required term matches nothing. Values are compared by their
    text; tokens in lower case. A field that is not listed has no terms and is in no range.
    """
    known = F.create_map(*[x for f in number_fields for x in (F.lit(f), field_column(docs, f, 0.0).cast("double"))]) if number_fields else F.create_map().cast("map<string,double>")
    rows = docs.select(F.col(id_col).alias("_doc"), _terms(docs, list(text_fields), list(value_fields)).alias("_terms"), known.alias("_numbers"))
    index = indexed(queries)
    found = rows.select("_doc", F.explode("_terms").alias("anchor")).join(index.select("anchor", "query_id"), "anchor")
    candidates = found.select(F.col("_doc").alias("_candidate"), "query_id").distinct()
    pairs = rows.join(candidates, F.col("_doc").eqNullSafe(F.col("_candidate"))).join(index.drop("anchor"), "query_id")
    number = lambda r: F.try_element_at("_numbers", r["field"])
    inside = lambda r: number(r).isNotNull() & F.coalesce(number(r) >= r["low"], F.lit(True)) & F.coalesce(number(r) < r["high"], F.lit(True))
    # Few terms are looked up in many: no set of a document's terms is built for each candidate.
    held = lambda term: F.array_contains("_terms", term)
    holds = (
        F.coalesce(F.forall("ranges", inside), F.lit(True))
        & F.forall("required", held)
        & ~F.coalesce(F.exists("excluded", held), F.lit(False))
    )
    return pairs.where(holds).select(F.col("_doc").alias(id_col), "query_id")


def standing_queries(
    stream: DataFrame, queries: DataFrame, path: str, checkpoint: str, id_col: str, text_fields=(), value_fields=(), number_fields=(), **trigger
) -> StreamingQuery:
    """Write the matches of every micro-batch to a folder of its own under ``path``; a batch that is run again replaces its folder."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        matches = percolate(batch, queries, id_col, text_fields, value_fields, number_fields)
        matches.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
