"""Reading by id, counting and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

import quillspan as q
from checks.registry import check
from quillspan.plans.keyset import Keyset

ID = "doc_id"


@check(
    "q_get_found",
    "SELECT doc_id, true AS found, text, lang, source, n_chars FROM documents WHERE doc_id = 17",
)
def get_found(table):
    return q.get(table("documents"), 17, ID, type_col="lang")


@check(
    "q_get_missing",
    "SELECT -5::BIGINT AS doc_id, count(*) > 0 AS found, max(lang) AS lang, max(n_chars) AS n_chars "
    "FROM documents WHERE doc_id = -5",
)
def get_missing(table):
    return q.get(table("documents"), -5, ID, type_col="lang").select(ID, "found", "lang", "n_chars")


@check(
    "q_multi_get",
    "SELECT i.c_custkey, c.c_custkey IS NOT NULL AS found, c_name, c_nationkey, c_acctbal, c_mktsegment, "
    "CASE WHEN c.c_custkey IS NULL THEN 'not found' END AS error "
    "FROM (SELECT DISTINCT event_id AS c_custkey FROM events) i LEFT JOIN customer c ON c.c_custkey = i.c_custkey",
)
def multi_get(table):
    return q.multi_get(table("customer"), table("events").select("event_id"), "c_custkey")


@check(
    "q_multi_get_field",
    "SELECT i.doc_id, d.doc_id IS NOT NULL AS found, source, "
    "CASE WHEN d.doc_id IS NULL THEN 'not found' END AS error "
    "FROM (VALUES (3::BIGINT), (1), (150), (999999999)) i(doc_id) LEFT JOIN documents d ON d.doc_id = i.doc_id",
)
def multi_get_field(table):
    return q.multi_get(table("documents"), [3, 1, 3, 150, 999999999, 1], ID, fields=["source"])


@check("q_count", "SELECT count(*) AS count FROM documents")
def count(table):
    return q.count(table("documents"))


@check("q_count_type", "SELECT count(*) AS count FROM documents WHERE lang = 'de'")
def count_type(table):
    return q.count(table("documents"), "de", type_col="lang")


@check(
    "q_hits_count",
    "SELECT count(*) AS total FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 20",
)
def hits_count(table):
    return q.hits_count(table("lineitem"), q.term("l_returnflag", "R"), q.range_("l_quantity", ("gte", 20)))


@check(
    "q_projection",
    "SELECT l_orderkey, l_shipdate, l_discount, 1.0::DOUBLE AS score FROM lineitem WHERE l_tax > 0.06",
)
def projection(table):
    return q.search(
        table("lineitem"),
        "l_orderkey",
        query=q.range_("l_tax", ("gt", 0.06)),
        size=None,
        fields=["l_orderkey", "l_shipdate", "l_discount"],
    ).hits


@check(
    "q_scroll_pages",
    "SELECT o_orderkey, (row_number() OVER o) - 1 AS row_index, ((row_number() OVER o) - 1) // 100 AS page_no "
    "FROM orders WINDOW o AS (ORDER BY o_orderpriority ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey)",
)
def scroll_pages(table):
    orders = table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    paged = q.pages(orders, [("o_orderpriority", "asc"), ("o_totalprice", "desc")], "o_orderkey")
    return paged.select("o_orderkey", "row_index", "page_no")


@check("q_array_join", "SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs FROM documents GROUP BY source")
def array_join(table):
    langs = table("documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("langs"))
    return langs.select("source", F.array_join("langs", ",").alias("langs"))


def _orders_in_pages(table):
    orders = table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_custkey")
    return Keyset(orders, [("o_orderpriority", "asc"), ("o_totalprice", "desc")], "o_orderkey", rows=2000)


PAGED = (
    "SELECT o_orderkey, o_orderpriority, o_totalprice, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderpriority NULLS LAST, "
    "o_totalprice DESC NULLS LAST, o_orderkey) - 1 AS place FROM orders) WHERE place BETWEEN {0} AND {1}"
)


@check("q_export_page", PAGED.format(1200, 1299))
def export_page(table):
    """A deep page, read from the ranges it lies in."""
    return _orders_in_pages(table).page(12, 100)


@check("q_export_after", PAGED.format(1300, 1399))
def export_after(table):
    """The page after the last row of another one, found by that row's key."""
    pages = _orders_in_pages(table)
    return pages.after(pages.page(12, 100).collect()[-1], 100)


@check(
    "q_export_ranges",
    "SELECT count(*) AS docs, count(*) AS ends, min(o_orderpriority) AS first, max(o_orderpriority) AS last FROM orders",
)
def export_ranges(table):
    """The ranges of the key cover every document once."""
    ranges, ends = _orders_in_pages(table).ranges, F.max(F.col("start") + F.col("n")).alias("ends")
    return ranges.agg(F.sum("n").alias("docs"), ends, F.min("first.k0").alias("first"), F.max("last.k0").alias("last"))
