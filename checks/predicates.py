"""Predicates, sections, order and pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

import quillspan as q
from checks.registry import check
from quillspan.functions import geo

ORDER = "o_orderkey"


def keys(hits, *columns):
    return hits.select(*columns)


def order_hits(table, *columns, **sections):
    fields = [ORDER, *columns]
    return q.search(table("orders"), ORDER, size=None, fields=fields, **sections).hits


@check(
    "q_search_basic",
    "SELECT doc_id, source, n_chars, CAST(NULL AS DOUBLE) AS score FROM documents "
    "WHERE lang = 'fr' AND n_chars >= 1000 ORDER BY n_chars DESC, doc_id LIMIT 10",
)
def search_basic(table):
    return q.search(
        table("documents"),
        "doc_id",
        query=q.range_("n_chars", ("gte", 1000)),
        type_name="fr",
        type_col="lang",
        sort=[("n_chars", "desc")],
        fields=["doc_id", "source", "n_chars"],
    ).hits


@check("q_term", "SELECT o_orderkey, 1.0::DOUBLE AS score FROM orders WHERE o_orderstatus = 'F'")
def term(table):
    return order_hits(table, query=q.term("o_orderstatus", "F"))


@check(
    "q_terms",
    "SELECT o_orderkey, o_orderpriority, 1.0::DOUBLE AS score FROM orders "
    "WHERE o_orderpriority IN ('1-URGENT', '5-LOW')",
)
def terms(table):
    return order_hits(table, "o_orderpriority", query=q.terms("o_orderpriority", ["1-URGENT", "5-LOW", "5-LOW"]))


@check("q_terms_empty", "SELECT o_orderkey, 1.0::DOUBLE AS score FROM orders WHERE false")
def terms_empty(table):
    return order_hits(table, query=q.terms("o_orderpriority", []))


@check(
    "q_range",
    "SELECT o_orderkey, o_totalprice, 1.0::DOUBLE AS score FROM orders "
    "WHERE o_totalprice >= 1000 AND o_totalprice < 50000",
)
def range_both(table):
    return order_hits(table, "o_totalprice", query=q.range_("o_totalprice", ("gte", 1000), ("lt", 50000)))


@check(
    "q_range_one_sided",
    "SELECT event_id, 1.0::DOUBLE AS score FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'",
)
def range_one_sided(table):
    after = q.range_("ts", ("gt", dt.datetime(2024, 1, 20)))
    return q.search(table("events"), "event_id", query=after, size=None, fields=["event_id"]).hits


@check("q_prefix", "SELECT p_partkey, p_name, 1.0::DOUBLE AS score FROM part WHERE starts_with(p_name, 'small ')")
def prefix(table):
    return q.search(
        table("part"), "p_partkey", query=q.prefix("p_name", "small "), size=None, fields=["p_partkey", "p_name"]
    ).hits


@check("q_match_all", "SELECT c_custkey, c_mktsegment, 1.0::DOUBLE AS score FROM customer")
def match_all(table):
    return q.search(
        table("customer"), "c_custkey", query=q.match_all(), size=None, fields=["c_custkey", "c_mktsegment"]
    ).hits


@check(
    "q_bool",
    "SELECT o_orderkey, 1.0 + (o_totalprice > 300000)::INT + (o_orderstatus = 'F')::INT AS score "
    "FROM (SELECT *, 0.0::DOUBLE AS z FROM orders) WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'".replace(
        "1.0 +", "z + 1.0 +"
    ),
)
def bool_all(table):
    return order_hits(
        table,
        query=q.bool_(
            must=q.term("o_orderpriority", "1-URGENT"),
            should=[q.range_("o_totalprice", ("gt", 300000)), q.term("o_orderstatus", "F")],
            must_not=q.term("o_orderstatus", "P"),
        ),
    )


@check(
    "q_bool_msm",
    "SELECT o_orderkey, k::DOUBLE AS score FROM (SELECT *, (o_totalprice > 200000)::INT + (o_orderstatus = 'F')::INT "
    "+ (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS k FROM orders) WHERE k >= 2",
)
def bool_minimum(table):
    return order_hits(
        table,
        query=q.bool_(
            should=[
                q.range_("o_totalprice", ("gt", 200000)),
                q.term("o_orderstatus", "F"),
                q.terms("o_orderpriority", ["1-URGENT", "2-HIGH"]),
            ],
            minimum_should_match="67%",
        ),
    )


@check(
    "q_bool_must_not_null",
    "SELECT doc_id, toxic, 1.0::DOUBLE AS score FROM documents LEFT JOIN labels USING (doc_id) "
    "WHERE toxic IS NULL OR toxic <> 1",
)
def must_not_keeps_missing(table):
    docs = table("documents").join(table("labels"), "doc_id", "left")
    return q.search(
        docs, "doc_id", query=q.bool_(must_not=q.term("toxic", 1)), size=None, fields=["doc_id", "toxic"]
    ).hits


@check(
    "q_or_filter",
    "SELECT o_orderkey, 1.0::DOUBLE AS score FROM orders WHERE o_orderstatus = 'P' OR o_totalprice < 20000",
)
def or_filter(table):
    either = q.or_filter([q.term("o_orderstatus", "P"), q.range_("o_totalprice", ("lt", 20000))])
    return order_hits(table, filter=either)


@check(
    "q_filtered",
    "SELECT o_orderkey, 1.0 + (o_orderstatus = 'F')::INT::DOUBLE AS score FROM orders "
    "WHERE o_totalprice > 100000 AND o_orderpriority IN ('1-URGENT', '5-LOW')",
)
def filtered(table):
    query = q.bool_(must=q.range_("o_totalprice", ("gt", 100000)), should=q.term("o_orderstatus", "F"))
    return order_hits(table, query=q.filtered(query, q.terms("o_orderpriority", ["1-URGENT", "5-LOW"])))


@check(
    "q_post_filter",
    "SELECT 'by_status' AS agg, o_orderstatus AS key, count(*) AS doc_count FROM orders WHERE o_totalprice > 100000 "
    "GROUP BY 2 UNION ALL SELECT 'total', 'hits', count(*) FROM orders WHERE o_totalprice > 100000 "
    "AND o_orderstatus = 'F'",
)
def post_filter(table):
    result = q.search(
        table("orders"),
        ORDER,
        filter=q.range_("o_totalprice", ("gt", 100000)),
        post_filter=q.term("o_orderstatus", "F"),
        aggs={"by_status": q.agg_terms("o_orderstatus")},
    )
    total = result.summary.select(
        F.lit("total").alias("agg"), F.lit("hits").alias("key"), F.col("total").alias("doc_count")
    )
    return result.aggs.unionByName(total)


@check(
    "q_sections",
    "SELECT o_orderkey, 2.0::DOUBLE AS score FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000 "
    "AND o_orderpriority = '2-HIGH'",
)
def sections(table):
    return order_hits(
        table,
        query=[q.term("o_orderstatus", "F"), None, q.range_("o_totalprice", ("gt", 50000)), q.prefix("o_orderstatus", "")],
        filter=[None, q.term("o_orderpriority", "2-HIGH")],
        post_filter=[None],
    )


@check(
    "q_geo_distance",
    "WITH c AS (SELECT c_custkey, (c_custkey % 180) - 90 AS lat, ((c_custkey * 7) % 360) - 180 AS lon FROM customer) "
    "SELECT c_custkey, 1.0::DOUBLE AS score FROM c WHERE 2 * 6371008.7714 * asin(sqrt(least(1.0, "
    "power(sin(radians(lat - 48.85) / 2), 2) + cos(radians(lat)) * cos(radians(48.85)) * "
    "power(sin(radians(lon - 2.35) / 2), 2)))) <= 3000000",
)
def geo_distance(table):
    placed = table("customer").select(
        "c_custkey",
        F.struct(
            ((F.col("c_custkey") % 180) - 90).cast("double").alias("lat"),
            (((F.col("c_custkey") * 7) % 360) - 180).cast("double").alias("lon"),
        ).alias("place"),
    )
    near = q.geo_distance("place", "48.85", "2.35", "3000km")
    return q.search(placed, "c_custkey", filter=near, size=None, fields=["c_custkey"]).hits


@check(
    "q_geo_antimeridian",
    "WITH c AS (SELECT c_custkey, (c_custkey % 180) - 90 AS lat, ((c_custkey * 7) % 360) - 180 AS lon FROM customer), "
    "m AS (SELECT c_custkey, round(2 * 6371008.7714 * asin(sqrt(least(1.0, power(sin(radians(lat + 17.5) / 2), 2) + "
    "cos(radians(lat)) * cos(radians(-17.5)) * power(sin(radians(lon - 178.5) / 2), 2)))), 1) AS metres FROM c) "
    "SELECT c_custkey, metres FROM m WHERE metres <= 2000000",
)
def geo_antimeridian(table):
    placed = table("customer").select(
        "c_custkey",
        F.struct(
            ((F.col("c_custkey") % 180) - 90).cast("double").alias("lat"),
            (((F.col("c_custkey") * 7) % 360) - 180).cast("double").alias("lon"),
        ).alias("place"),
    )
    near = q.matching(placed, q.geo_distance("place", -17.5, 178.5, "2000000m"))
    away = geo.haversine_m(F.col("place.lat"), F.col("place.lon"), -17.5, 178.5)
    return near.select("c_custkey", F.round(away, 1).alias("metres"))


@check(
    "q_matched_queries",
    "SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'F' THEN 'done' END, "
    "CASE WHEN o_totalprice > 200000 THEN 'large' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END) "
    "AS matched FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 200000 OR o_orderpriority = '1-URGENT'",
)
def matched_queries(table):
    hits = order_hits(
        table,
        query=q.bool_(
            should=[
                q.term("o_orderstatus", "F", name="done##1"),
                q.range_("o_totalprice", ("gt", 200000), name="large"),
                q.term("o_orderpriority", "1-URGENT", name="urgent##x##y"),
            ]
        ),
    )
    return hits.select(ORDER, F.array_join("matched_queries", ",").alias("matched"))


@check(
    "q_template",
    "SELECT o_orderkey, 2.0::DOUBLE AS score FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 250000",
)
def template(table):
    def expensive(status, floor):
        return q.bool_(must=[q.term("o_orderstatus", status), q.range_("o_totalprice", ("gte", floor))])

    return order_hits(table, query=q.template(expensive, {"status": "O", "floor": 250000}))


@check(
    "q_terms_lookup",
    "SELECT c_custkey, c_name, 1.0::DOUBLE AS score FROM customer WHERE c_custkey IN "
    "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')",
)
def terms_lookup(table):
    urgent = table("orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    return q.search(
        table("customer"),
        "c_custkey",
        filter=q.terms_lookup("c_custkey", urgent, "o_custkey"),
        size=None,
        fields=["c_custkey", "c_name"],
    ).hits


@check(
    "q_terms_lookup_not",
    "SELECT c_custkey, c_name, 1.0::DOUBLE AS score FROM customer WHERE c_custkey NOT IN "
    "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')",
)
def terms_lookup_not(table):
    urgent = table("orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    return q.search(
        table("customer"),
        "c_custkey",
        filter=q.bool_(must_not=q.terms_lookup("c_custkey", urgent, "o_custkey")),
        size=None,
        fields=["c_custkey", "c_name"],
    ).hits


@check(
    "q_terms_lookup_named",
    "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) "
    "THEN 'big_spender' ELSE '' END AS matched FROM customer",
)
def terms_lookup_named(table):
    big = table("orders").where("o_totalprice > 400000")
    lookup = q.terms_lookup("c_custkey", big, "o_custkey", name="big_spender")
    hits = q.search(
        table("customer"),
        "c_custkey",
        query=q.bool_(must=q.match_all(), should=lookup),
        size=None,
        fields=["c_custkey"],
    ).hits
    return hits.select("c_custkey", F.array_join("matched_queries", ",").alias("matched"))


def baskets(table):
    """Orders with the parts they hold."""
    lines = table("lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_partkey")).alias("parts"))
    return lines.withColumn("parts", F.when(F.col("l_orderkey") % 7 != 0, F.col("parts")))


HOLDS_SMALL = "l_orderkey % 7 <> 0 AND bool_or(l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 3))"


@check("q_terms_lookup_array", f"SELECT l_orderkey, 1.0::DOUBLE AS score FROM lineitem GROUP BY l_orderkey HAVING {HOLDS_SMALL}")
def terms_lookup_array(table):
    small = q.terms_lookup("parts", table("part").where("p_size <= 3"), "p_partkey")
    return q.search(baskets(table), "l_orderkey", filter=small, size=None, fields=["l_orderkey"]).hits


@check("q_terms_lookup_array_not", f"SELECT l_orderkey, 1.0::DOUBLE AS score FROM lineitem GROUP BY l_orderkey HAVING NOT ({HOLDS_SMALL})")
def terms_lookup_array_not(table):
    small = q.terms_lookup("parts", table("part").where("p_size <= 3"), "p_partkey")
    return q.search(baskets(table), "l_orderkey", filter=q.bool_(must_not=small), size=None, fields=["l_orderkey"]).hits


@check(
    "q_sort_multi",
    "SELECT doc_id, toxic, n_chars FROM documents LEFT JOIN labels USING (doc_id) "
    "ORDER BY toxic ASC NULLS LAST, n_chars DESC NULLS LAST, doc_id LIMIT 500",
)
def sort_multi(table):
    docs = table("documents").join(table("labels"), "doc_id", "left")
    return q.search(
        docs,
        "doc_id",
        sort=[("toxic", "asc"), ("n_chars", "desc")],
        size=500,
        fields=["doc_id", "toxic", "n_chars"],
    ).hits.drop("score")


@check(
    "q_topk",
    "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_partkey, l_orderkey "
    "LIMIT 25",
)
def topk(table):
    return q.search(
        table("lineitem"),
        "l_orderkey",
        sort=[("l_extendedprice", "desc"), ("l_partkey", "asc")],
        size=25,
        fields=["l_orderkey", "l_partkey", "l_extendedprice"],
    ).hits.drop("score")


@check(
    "q_topk_from",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40",
)
def topk_from(table):
    return q.search(
        table("orders"),
        ORDER,
        sort=[("o_totalprice", "desc")],
        size=20,
        from_=40,
        fields=[ORDER, "o_totalprice"],
    ).hits.drop("score")


@check(
    "q_deep_page",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, "
    "l_partkey, l_suppkey, l_linenumber, l_orderkey LIMIT 150000 OFFSET 1000",
)
def deep_page(table):
    return q.search(
        table("lineitem"),
        "l_orderkey",
        sort=[("l_extendedprice", "desc"), ("l_partkey", "asc"), ("l_suppkey", "asc"), ("l_linenumber", "asc")],
        size=150000,
        from_=1000,
        fields=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"],
    ).hits.drop("score")
