"""Aggregations and folded pages."""

from __future__ import annotations

from pyspark.sql import functions as F

import quillspan as q
from checks.registry import check, words_sql
from quillspan.functions import text as ta
from quillspan.operators import responses
from quillspan.sources.readers import spread

TOP = "ORDER BY doc_count DESC, key ASC LIMIT"


@check(
    "q_agg_terms",
    f"SELECT user_id AS key, count(*) AS doc_count FROM events WHERE event_type <> 'error' GROUP BY 1 {TOP} 10",
)
def agg_terms(table):
    kept = q.matching(table("events"), q.bool_(must_not=q.term("event_type", "error")))
    return q.terms_agg(kept, "user_id")


@check(
    "q_agg_terms_array",
    f"SELECT key, count(*) AS doc_count FROM (SELECT unnest(list_distinct({words_sql()})) AS key FROM documents) "
    f"GROUP BY 1 {TOP} 100",
)
def agg_terms_array(table):
    words = spread(table("documents")).select("doc_id", ta.tokens(F.col("text")).alias("words"))
    return q.terms_agg(words, "words", size=100)


@check(
    "q_agg_terms_other",
    "WITH c AS (SELECT p_name AS key, count(*) AS doc_count FROM part GROUP BY 1), "
    f"t AS (SELECT * FROM c {TOP} 7) "
    "SELECT key, doc_count, ((SELECT sum(doc_count) FROM c) - (SELECT sum(doc_count) FROM t))::BIGINT "
    "AS sum_other_doc_count FROM t",
)
def agg_terms_other(table):
    return q.terms_agg(table("part"), "p_name", size=7, sum_other=True)


@check(
    "q_agg_ranges",
    "SELECT 'small' AS key, count(*) FILTER (WHERE l_quantity < 10) AS doc_count FROM lineitem UNION ALL "
    "SELECT 'medium', count(*) FILTER (WHERE l_quantity >= 10 AND l_quantity < 30) FROM lineitem UNION ALL "
    "SELECT 'large', count(*) FILTER (WHERE l_quantity >= 30) FROM lineitem UNION ALL "
    "SELECT 'huge', count(*) FILTER (WHERE l_quantity >= 1000) FROM lineitem",
)
def agg_ranges(table):
    return q.ranges_agg(
        table("lineitem"),
        "l_quantity",
        [q.bucket("small", to=10.0), q.bucket("medium", 10.0, 30.0), q.bucket("large", 30.0), q.bucket("huge", 1000.0), q.bucket("none")],
    )


@check(
    "q_agg_ranges_overlap",
    "SELECT 'cheap' AS key, count(*) FILTER (WHERE l_extendedprice < 30000) AS doc_count FROM lineitem UNION ALL "
    "SELECT 'middle', count(*) FILTER (WHERE l_extendedprice >= 10000 AND l_extendedprice < 60000) FROM lineitem "
    "UNION ALL SELECT 'all', count(*) FILTER (WHERE l_extendedprice >= 0) FROM lineitem",
)
def agg_ranges_overlap(table):
    return q.ranges_agg(
        table("lineitem"),
        "l_extendedprice",
        [q.bucket("cheap", to=30000.0), q.bucket("middle", 10000.0, 60000.0), q.bucket("all", 0.0)],
    )


@check(
    "q_multi_aggs",
    "WITH e AS (SELECT * FROM events WHERE value >= 5), "
    "u AS (SELECT 'by_user' AS agg, user_id::VARCHAR AS key, count(*) AS doc_count FROM e GROUP BY 2 "
    "ORDER BY doc_count DESC, key LIMIT 5) "
    "SELECT 'by_type' AS agg, event_type AS key, count(*) AS doc_count FROM e GROUP BY 2 UNION ALL SELECT * FROM u "
    "UNION ALL SELECT 'by_value', 'low', count(*) FILTER (WHERE value < 50) FROM e "
    "UNION ALL SELECT 'by_value', 'not_high', count(*) FILTER (WHERE value < 200) FROM e "
    "UNION ALL SELECT 'by_value', 'beyond', count(*) FILTER (WHERE value >= 100000) FROM e",
)
def multi_aggs(table):
    return q.search(
        table("events"),
        "event_id",
        filter=q.range_("value", ("gte", 5)),
        post_filter=q.term("event_type", "view"),
        aggs={
            "by_type": q.agg_terms("event_type"),
            "by_user": q.agg_terms("user_id", size=5),
            "by_value": q.agg_ranges(
                "value", [q.bucket("low", to=50.0), q.bucket("not_high", to=200.0), q.bucket("beyond", 100000.0)]
            ),
        },
    ).aggs


@check(
    "q_agg_nested",
    "WITH h AS (SELECT l_suppkey AS key, count(*) AS doc_count FROM lineitem GROUP BY 1 " + TOP + " 5), "
    "c AS (SELECT l_suppkey AS key, l_returnflag AS sub_key, count(*) AS sub_doc_count, "
    "sum(l_quantity) AS quantity, max(l_extendedprice) AS top_price FROM lineitem GROUP BY 1, 2), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY sub_doc_count DESC, sub_key) AS rn FROM c) "
    "SELECT key, doc_count, sub_key, sub_doc_count, quantity, top_price FROM r JOIN h USING (key) WHERE rn <= 2",
)
def agg_nested(table):
    return q.terms_agg(
        table("lineitem"),
        "l_suppkey",
        size=5,
        sub=q.agg_terms("l_returnflag", size=2),
        metrics={"quantity": F.sum("l_quantity"), "top_price": F.max("l_extendedprice")},
    )


def conversation_pages(table, failing_role=None):
    """Every conversation as a search whose turns are archived result pages."""
    body = F.to_json(
        F.struct(
            F.length("text").alias("took"),
            F.struct(
                F.length("text").alias("total"),
                F.when(F.col("role") != "system", F.length("text") / 2.0).alias("max_score"),
                F.array(
                    F.struct(F.concat_ws("-", "conv_id", "turn").alias("_id"), F.col("turn").cast("double").alias("_score"))
                ).alias("hits"),
            ).alias("hits"),
            F.when(F.col("role") == "assistant", F.struct(F.col("turn").alias("by"))).alias("aggregations"),
        )
    )
    if failing_role:
        failure = F.to_json(F.struct(F.concat(F.lit("turn "), "turn").alias("error"), (F.col("turn") + 500).alias("status")))
        body = F.when((F.col("role") == failing_role) & (F.col("turn") > 4), failure).otherwise(body)
    archived = table("conversations").select(
        F.col("conv_id").alias("search_id"), F.col("turn").alias("page_no"), body.alias("payload")
    )
    return responses.pages_from_responses(archived)


PAGES = (
    "SELECT conv_id AS search_id, turn, role, length(text) AS len, CASE WHEN role = 'assistant' THEN "
    "'{\"by\":' || turn || '}' END AS aggregations FROM conversations"
)


@check(
    "q_page_fold",
    f"WITH p AS ({PAGES}) SELECT search_id, 'ok' AS outcome, sum(len)::BIGINT AS took, max(len)::BIGINT AS total, "
    "max(CASE WHEN role <> 'system' THEN len / 2.0::DOUBLE END) AS max_score, "
    "arg_min(aggregations, turn) FILTER (WHERE aggregations IS NOT NULL) AS aggregations, "
    "CAST(NULL AS VARCHAR) AS error, CAST(NULL AS INT) AS status FROM p GROUP BY search_id",
)
def page_fold(table):
    return q.fold_pages(conversation_pages(table))


@check(
    "q_page_fold_error",
    f"WITH p AS ({PAGES}), f AS (SELECT search_id, min(turn) AS bad FROM p WHERE role = 'user' AND turn > 4 GROUP BY 1) "
    "SELECT p.search_id, CASE WHEN any_value(bad) IS NULL THEN 'ok' ELSE 'error' END AS outcome, "
    "CASE WHEN any_value(bad) IS NULL THEN sum(len)::BIGINT END AS took, "
    "CASE WHEN any_value(bad) IS NULL THEN max(len)::BIGINT END AS total, "
    "CASE WHEN any_value(bad) IS NULL THEN max(CASE WHEN role <> 'system' THEN len / 2.0::DOUBLE END) END AS max_score, "
    "CASE WHEN any_value(bad) IS NULL THEN arg_min(aggregations, turn) FILTER (WHERE aggregations IS NOT NULL) END "
    "AS aggregations, 'turn ' || any_value(bad) AS error, (any_value(bad) + 500)::INT AS status "
    "FROM p LEFT JOIN f ON p.search_id = f.search_id GROUP BY p.search_id",
)
def page_fold_error(table):
    return q.fold_pages(conversation_pages(table, failing_role="user"))


@check(
    "q_page_hits",
    "SELECT conv_id AS search_id, turn AS page_no, 0 AS pos, conv_id || '-' || turn AS _id, turn::DOUBLE AS _score "
    "FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'user' AND turn > 4)",
)
def page_hits(table):
    hits = q.fold_hits(conversation_pages(table, failing_role="user"))
    return hits.select("search_id", "page_no", "pos", "_id", "_score")


@check(
    "q_agg_tree",
    "WITH l1 AS (SELECT event_type AS t, count(*) AS n, max(value) AS m FROM events WHERE t IS NOT NULL GROUP BY 1 ORDER BY n DESC, t LIMIT 3), "
    "r(k, lo, hi) AS (VALUES ('low', NULL, 10.0), ('mid', 5.0, 50.0), ('far', 1e12, NULL)), "
    "x AS (SELECT t, k, user_id AS u, value AS v, coalesce((lo IS NULL OR value >= lo) AND (hi IS NULL OR value < hi), false) AS inside "
    "FROM l1 JOIN events ON event_type = t CROSS JOIN r), "
    "g AS (SELECT t, k, u::VARCHAR AS name, count(*) AS n, max(v) AS m FROM x WHERE inside AND u IS NOT NULL GROUP BY 1, 2, 3), "
    "l3 AS (SELECT *, row_number() OVER (PARTITION BY t, k ORDER BY n DESC, name) AS rn FROM g) "
    "SELECT 'type' AS agg, t AS path, n AS doc_count, m AS largest FROM l1 UNION ALL "
    "SELECT 'type/value', t || '>' || k, count(*) FILTER (WHERE inside), max(v) FILTER (WHERE inside) FROM x GROUP BY t, k UNION ALL "
    "SELECT 'type/value/user', t || '>' || k || '>' || name, n, m FROM l3 WHERE rn <= 2",
)
def agg_tree(table):
    ranges = q.agg_ranges("value", [q.bucket("low", to=10.0), q.bucket("mid", 5.0, 50.0), q.bucket("far", 1e12)])
    tree = q.split("type", q.agg_terms("event_type", 3), q.split("value", ranges, q.split("user", q.agg_terms("user_id", 2))))
    found = q.agg_tree(table("events"), [tree], {"largest": ("max", "value")})
    return found.withColumn("path", F.array_join("path", ">"))
