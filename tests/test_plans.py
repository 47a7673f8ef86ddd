"""What the plans must and must not contain."""

import os

import pytest
from pyspark.sql import functions as F

import quillspan as q

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def read(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def test_predicates_reach_the_scan(spark, plan):
    query = q.bool_(
        must=[q.term("o_orderstatus", "F"), q.range_("o_totalprice", ("gte", 10.0), ("lt", 20.0)), q.prefix("o_orderpriority", "1")]
    )
    text = plan(q.search(read(spark, "orders"), "o_orderkey", query=query, size=None, fields=["o_orderkey"]).hits)
    for part in ("EqualTo(o_orderstatus,F)", "GreaterThanOrEqual(o_totalprice", "LessThan(o_totalprice", "StringStartsWith(o_orderpriority,1)"):
        assert part in text
    assert "Exchange" not in text


def test_only_asked_columns_are_read(spark, plan):
    text = plan(q.search(read(spark, "lineitem"), "l_orderkey", query=q.term("l_returnflag", "R"), size=None, fields=["l_orderkey"]).hits)
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def test_geo_box_reaches_the_scan(spark, plan, tmp_path):
    spark.createDataFrame([((1.0, 2.0),)], "p struct<lat: double, lon: double>").write.parquet(str(tmp_path / "p"))
    text = plan(q.matching(spark.read.parquet(str(tmp_path / "p")), q.geo_distance("p", 1, 2, "5km")))
    assert "GreaterThanOrEqual(p.lat" in text and "LessThanOrEqual(p.lon" in text


def test_top_k_does_not_sort_everything(spark, plan):
    text = plan(q.search(read(spark, "orders"), "o_orderkey", sort=[("o_totalprice", "desc")], size=5).hits)
    assert "TakeOrderedAndProject" in text and "Exchange rangepartitioning" not in text


def test_lookups_are_equi_joins(spark, plan):
    orders = read(spark, "orders")
    yes = q.matching(read(spark, "customer"), q.terms_lookup("c_custkey", orders, "o_custkey"))
    no = q.matching(read(spark, "customer"), q.bool_(must_not=q.terms_lookup("c_custkey", orders, "o_custkey")))
    for df, kind in ((yes, "LeftSemi"), (no, "LeftAnti")):
        text = plan(df)
        assert kind in text and "NestedLoop" not in text and "Cartesian" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(q.matching(read(spark, "customer"), q.terms_lookup("c_custkey", orders, "o_custkey")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookups_of_array_fields_are_equi_joins(spark, plan):
    rows = [(1, ["a", None]), (2, []), (3, None), (4, ["b", "c"]), (5, [None]), (6, ["c", "b"]), (6, ["c", "b"]), (7, ["d"])]
    docs = spark.createDataFrame(rows, "id int, tags array<string>")
    for values, found in ((["a", "c", None], [1, 4, 6, 6]), ([], []), ([None], [])):
        for lookup in (spark.createDataFrame([(v,) for v in values], "v string"), spark.createDataFrame([(values,)], "v array<string>")):
            clause = q.terms_lookup("tags", lookup, "v", name="hit")
            assert sorted(r["id"] for r in q.matching(docs, clause).collect()) == found
            rest = q.matching(docs, q.bool_(must_not=clause))
            assert sorted(r["id"] for r in rest.collect()) == sorted(i for i, _ in rows if i not in found)
            assert "NestedLoop" not in plan(rest) and "Cartesian" not in plan(rest)
    named = q.search(docs, "id", query=q.bool_(must=q.match_all(), should=q.terms_lookup("tags", spark.createDataFrame([("d",)], "v string"), "v", name="d")), size=None)
    assert [r["id"] for r in named.hits.where(F.array_contains("matched_queries", "d")).collect()] == [7]


def test_corpus_statistics_are_no_join(spark, plan):
    hits = q.search(read(spark, "documents"), "doc_id", query=q.match("text", "the of"), fields=["doc_id"]).hits
    text = plan(hits)
    assert "Join" not in text and "TakeOrderedAndProject" in text


def test_aggregations_combine_before_the_shuffle(spark, plan):
    text = plan(q.run_aggs(read(spark, "events"), {"a": q.agg_terms("event_type"), "b": q.agg_terms("user_id")}))
    assert "partial_sum" in text and "WindowGroupLimit" in text


def test_id_lists_are_pushed_down(spark, plan):
    text = plan(q.multi_get(read(spark, "customer"), [1, 2, 3], "c_custkey"))
    assert "In(c_custkey, [1,2,3])" in text


def test_responses_are_parsed_once_without_a_shuffle(spark, plan):
    from quillspan.operators import responses

    df = read(spark, "events").select("event_id", F.col("props").alias("payload"))
    text = plan(responses.search_hits(df))
    assert "Exchange" not in text
    assert text.split("FileScan")[0].count("from_json") <= 1
