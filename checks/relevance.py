"""Text analysis, matching and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

import quillspan as q
from checks.registry import (
    all_sql,
    any_sql,
    bm25_sql,
    check,
    corpus_sql,
    tf_sql,
    weight_sql,
    words_sql,
)
from quillspan.functions import text as ta
from quillspan.functions.rows import unnest
from quillspan.plans.durable import new_folder
from quillspan.plans.positions import Positions, match_positions, phrase_positions, read_positions, top_positions, write_positions
from quillspan.plans.postings import match_postings, read_postings, write_postings
from quillspan.sources.readers import spread

ID = "doc_id"
TWO = ["the", "of"]
THREE = ["the", "of", "les"]


def texts(table):
    return spread(table("documents"))


def scored(table, query, **sections):
    return q.search(texts(table), ID, query=query, size=None, fields=[ID], **sections).hits


def scored_sql(terms, score, where):
    return f"WITH {corpus_sql(terms)} SELECT doc_id, round({score}, 6) AS score FROM d, s WHERE {where}"


@check(
    "q_analyze_tokens",
    f"SELECT token, count(*) AS n FROM (SELECT unnest({words_sql()}) AS token FROM documents) GROUP BY token",
)
def analyze_tokens(table):
    words = texts(table).select(ta.analyzed(F.col("text")).alias("t"))
    return unnest(words, "t", "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))


# Each token is where its offsets say, ends where the rest of the text goes on, and no token is missed.
@check(
    "q_analyze_offsets",
    f"WITH w AS (SELECT doc_id, {words_sql()} AS t, text FROM documents), "
    "e AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS position FROM w), "
    f"g AS (SELECT doc_id, string_split_regex(lower(text), '{words_sql().split(chr(39), 1)[1].rsplit(chr(39), 1)[0]}') AS gaps "
    "FROM documents), "
    "f AS (SELECT doc_id, unnest(gaps) AS gap, generate_subscripts(gaps, 1) AS position FROM g) "
    "SELECT e.doc_id, e.token, e.position::INT AS position, "
    "(sum(length(f.gap) + length(e.token)) OVER w - length(e.token))::INT AS start_offset, "
    "(sum(length(f.gap) + length(e.token)) OVER w)::INT AS end_offset, 'word' AS type "
    "FROM e JOIN f ON e.doc_id = f.doc_id AND e.position = f.position "
    "WINDOW w AS (PARTITION BY e.doc_id ORDER BY e.position)",
)
def analyze_offsets(table):
    analyzed = texts(table).select(ID, ta.analyze(F.col("text")).alias("t"))
    return unnest(analyzed, "t", "w").select(ID, "w.*")


@check(
    "q_edge_ngrams",
    f"WITH w AS (SELECT doc_id, unnest({words_sql()}) AS token FROM documents), "
    "g AS (SELECT doc_id, token, unnest(generate_series(1, least(20, length(token)))) AS n FROM w) "
    "SELECT left(token, n) AS gram, count(*) AS n FROM g GROUP BY 1",
)
def edge_ngrams(table):
    analyzed = texts(table).select(ta.analyzed(F.col("text"), "edge_ngrams").alias("t"))
    return unnest(analyzed, "t", "gram").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


@check("q_match_or", scored_sql(THREE, bm25_sql(THREE), any_sql(THREE)))
def match_or(table):
    return scored(table, q.match("text", "The of, LES the"))


@check("q_match_and", scored_sql(THREE, bm25_sql(THREE), all_sql(THREE)))
def match_and(table):
    return scored(table, q.match("text", "the of les", operator="and"))


@check(
    "q_match_minimum",
    scored_sql(
        THREE,
        bm25_sql(THREE),
        "list_contains(t, 'the')::INT + list_contains(t, 'of')::INT + list_contains(t, 'les')::INT >= 2",
    ),
)
def match_minimum(table):
    return scored(table, q.match("text", "the of les", minimum_should_match=2))


@check(
    "q_match_bm25",
    scored_sql(TWO, bm25_sql(TWO), f"{any_sql(TWO)} AND lang IN ('en', 'fr')") + " ORDER BY score DESC, doc_id LIMIT 10",
)
def match_bm25(table):
    return q.search(
        texts(table), ID, query=q.match("text", "the of"), filter=q.terms("lang", ["en", "fr"]), fields=[ID]
    ).hits


@check("q_match_postings", scored_sql(THREE, bm25_sql(THREE), any_sql(THREE)))
def match_by_postings(table):
    folder = new_folder(table.spark, "words")
    write_postings(texts(table), ID, "text", folder)
    hits = match_postings(read_postings(table.spark, folder), "the of les")
    return hits.withColumnRenamed("_id", ID)


@check(
    "q_unlimited",
    f"WITH {corpus_sql(TWO)} SELECT doc_id, round({bm25_sql(TWO)}, 6) AS score, "
    "CASE WHEN lang = 'en' THEN 'text,english' ELSE 'text' END AS matched "
    f"FROM d, s WHERE {any_sql(TWO)}",
)
def unlimited(table):
    named = q.bool_(must=q.match("text", "the of", name="text"))
    hits = q.unlimited_search(
        texts(table), ID, query=named, filter=q.or_filter([q.term("lang", "en", name="english"), q.match_all()])
    )
    return hits.withColumn("matched", F.array_join("matched_queries", ",")).drop("matched_queries")


@check(
    "q_multi_match",
    "WITH a AS (SELECT p_partkey, regexp_extract_all(lower(p_name), '[a-z]+') AS x, "
    "regexp_extract_all(lower(p_type), '[a-z]+') AS y FROM part), "
    "s AS (SELECT count(*) AS n, avg(len(x)) AS ax, avg(len(y)) AS ay, "
    "count(*) FILTER (WHERE list_contains(x, 'small')) AS x1, count(*) FILTER (WHERE list_contains(x, 'ring')) AS x2, "
    "count(*) FILTER (WHERE list_contains(y, 'small')) AS y1, count(*) FILTER (WHERE list_contains(y, 'ring')) AS y2 "
    "FROM a), "
    "w AS (SELECT p_partkey, x, y, "
    + " , ".join(
        f"(CASE WHEN {tf_sql(t, c)} > 0 THEN ln(1 + (n - {c}{i} + 0.5) / ({c}{i} + 0.5)) * ({tf_sql(t, c)} * 2.2) / "
        f"({tf_sql(t, c)} + 1.2 * (0.25 + 0.75 * len({c}) / a{c})) ELSE 0.0::DOUBLE END) AS w{c}{i}"
        for c in "xy"
        for i, t in ((1, "small"), (2, "ring"))
    )
    + " FROM a, s), b AS (SELECT p_partkey, wx1 + wx2 AS bx, wy1 + wy2 AS byy FROM w) "
    "SELECT p_partkey, round(greatest(bx, byy) + (bx + byy - greatest(bx, byy)) * 0.3, 6) AS score FROM b "
    "WHERE bx > 0 OR byy > 0",
)
def multi_match(table):
    query = q.multi_match(["p_name", "p_type"], "small ring", tie_breaker=0.3)
    return q.search(table("part"), "p_partkey", query=query, size=None, fields=["p_partkey"]).hits


@check(
    "q_phrase",
    scored_sql(["of", "the"], bm25_sql(["of", "the"]), "contains(' ' || array_to_string(t, '  ') || ' ', ' of  the ')"),
)
def phrase(table):
    return scored(table, q.multi_match(["text"], "of the", type="phrase"))


@check(
    "q_phrase_prefix",
    scored_sql(["of"], bm25_sql(["of"]), "contains(' ' || array_to_string(t, '  ') || ' ', ' of  th')"),
)
def phrase_prefix(table):
    return scored(table, q.phrase_prefix("text", "of th"))


def positions(table) -> Positions:
    folder = new_folder(table.spark, "positions")
    write_positions(table("documents"), ID, "text", folder, buckets=8, block_chars=1 << 16)
    return read_positions(table.spark, folder)


@check("q_match_positions", scored_sql(THREE, bm25_sql(THREE), all_sql(THREE)))
def match_by_positions(table):
    return match_positions(positions(table), "the of les", operator="and").withColumnRenamed("_id", ID)


@check("q_top_positions", scored_sql(THREE, bm25_sql(THREE), any_sql(THREE)) + " ORDER BY score DESC, doc_id LIMIT 25")
def top_by_positions(table):
    return top_positions(positions(table), "the of les", 25).withColumnRenamed("_id", ID)


@check(
    "q_phrase_positions",
    scored_sql(["of", "the"], bm25_sql(["of", "the"]), "contains(' ' || array_to_string(t, '  ') || ' ', ' of  the ')"),
)
def phrase_by_positions(table):
    return phrase_positions(positions(table), "of the").withColumnRenamed("_id", ID)


@check(
    "q_phrase_prefix_positions",
    scored_sql(["of"], bm25_sql(["of"]), "contains(' ' || array_to_string(t, '  ') || ' ', ' of  th')"),
)
def phrase_prefix_by_positions(table):
    return phrase_positions(positions(table), "of th", last_is_prefix=True).withColumnRenamed("_id", ID)


@check(
    "q_text_all_any_none",
    scored_sql(
        ["the", "of", "thing", "stion"],
        bm25_sql(["the", "of", "thing", "stion"]),
        f"{all_sql(['the', 'of'])} AND {any_sql(['thing', 'stion'])} AND NOT {any_sql(['les', 'der'])}",
    ),
)
def text_parts(table):
    return scored(
        table, q.text_query(["text"], all_terms="the of", any_terms="thing stion", none_terms="les der")
    )


@check(
    "q_boosting",
    scored_sql(TWO, f"{bm25_sql(TWO)} * CASE WHEN lang = 'fr' OR n_chars > 2000 THEN 0.2::DOUBLE ELSE 1.0 END", any_sql(TWO)),
)
def boosting(table):
    demoted = q.or_filter([q.term("lang", "fr"), q.range_("n_chars", ("gt", 2000))])
    return scored(table, q.boosting(q.match("text", "the of"), demoted))


FACTORS = (
    "WITH " + corpus_sql(TWO) + ", f AS (SELECT doc_id, " + bm25_sql(TWO) + " AS base, "
    "CASE WHEN lang = 'en' THEN 2.0::DOUBLE END AS a, CASE WHEN n_chars >= 1000 THEN 3.0::DOUBLE END AS b, "
    "CASE WHEN source = 'src1' THEN n_chars / 1000.0::DOUBLE END AS c FROM d, s WHERE " + any_sql(TWO) + ") "
    "SELECT doc_id, round(base * coalesce({combined}, 1), 6) AS score FROM f"
)
COMBINED = {
    "sum": "CASE WHEN coalesce(a, b, c) IS NOT NULL THEN coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) END",
    "max": "greatest(a, b, c)",
    "min": "least(a, b, c)",
    "first": "coalesce(a, b, c)",
    "multiply": "coalesce(a, 1) * coalesce(b, 1) * coalesce(c, 1)",
    "avg": "CASE WHEN coalesce(a, b, c) IS NOT NULL THEN (coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / "
    "((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT) END",
}


def _function_score(mode):
    @check(f"q_function_score_{mode}", FACTORS.replace("{combined}", COMBINED[mode]))
    def function_score(table):
        functions = [
            q.ScoreFunction(2, q.term("lang", "en")),
            q.ScoreFunction(3, q.range_("n_chars", ("gte", 1000))),
            q.ScoreFunction(F.col("n_chars") / 1000.0, q.term("source", "src1")),
        ]
        return scored(table, q.function_score(q.match("text", "the of"), functions, mode))


for _mode in COMBINED:
    _function_score(_mode)


@check(
    "q_dis_max",
    "WITH " + corpus_sql(["the", "of", "les"]) + ", p AS (SELECT doc_id, "
    + weight_sql(0, "the") + " AS a, " + weight_sql(1, "of") + " AS b, " + weight_sql(2, "les") + " AS c FROM d, s) "
    "SELECT doc_id, round((greatest(a, b, c) + (a + b + c - greatest(a, b, c)) * 0.4) * 1.5, 6) AS score FROM p "
    "WHERE a > 0 OR b > 0 OR c > 0",
)
def dis_max(table):
    return scored(
        table,
        q.dis_max([q.match("text", "the"), q.match("text", "of"), q.match("text", "les")], tie_breaker=0.4, boost=1.5),
    )


@check(
    "q_explain",
    "WITH " + corpus_sql(TWO) + ", p AS (SELECT doc_id, " + weight_sql(0, "the") + " AS a, " + weight_sql(1, "of")
    + " AS b, 1.0::DOUBLE AS c FROM d, s WHERE " + any_sql(TWO) + " AND lang = 'en') "
    "SELECT doc_id, 'text:the' AS part, round(a, 6) AS value FROM p UNION ALL "
    "SELECT doc_id, 'text:of', round(b, 6) FROM p UNION ALL SELECT doc_id, 'term(lang)', c FROM p",
)
def explain(table):
    hits = scored(table, [q.match("text", "the of"), q.term("lang", "en")], explain=True)
    return unnest(hits, "explanation", "part", "value").select(ID, "part", "value")


@check(
    "q_max_score",
    f"WITH {corpus_sql(TWO)} SELECT count(*) AS total, max(round({bm25_sql(TWO)}, 6)) AS max_score FROM d, s "
    f"WHERE {any_sql(TWO)}",
)
def max_score(table):
    return q.search(texts(table), ID, query=q.match("text", "the of")).summary
