"""Boosts, bucket options, fields of JSON documents and snapshots by reference."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import quillspan as q

JSON_DOCS = [
    ("1", '{"price": 9.5, "tags": ["a", "b"], "at": {"city": "Rome"}, "n": 3}'),
    ("2", '{"price": "cheap", "tags": [], "at": {"city": "Oslo"}, "n": 9007199254740993}'),
    ("3", '{"price": 20}'),
    ("4", "not json"),
    ("5", None),
]


@pytest.fixture()
def json_docs(spark):
    return spark.createDataFrame(JSON_DOCS, "_id string, _source string")


def ids(df):
    return sorted(r["_id"] for r in df.collect())


def test_clauses_reach_into_json(json_docs):
    assert ids(q.matching(json_docs, q.range_("price", ("gte", 9)))) == ["1", "3"]
    assert ids(q.matching(json_docs, q.term("at.city", "Oslo"))) == ["2"]
    assert ids(q.matching(json_docs, q.terms("n", [3, 9007199254740993]))) == ["1", "2"]
    assert ids(q.matching(json_docs, q.term("n", 9007199254740992))) == []
    assert ids(q.matching(json_docs, q.match("at.city", "rome oslo"))) == ["1", "2"]
    assert ids(q.matching(json_docs, q.bool_(must_not=q.term("price", 20)))) == ["1", "2", "4", "5"]


def test_json_fields_are_shown_sorted_and_counted(json_docs):
    hits = q.search(json_docs, "_id", sort=[("at.city", "asc")], fields=["price"], size=2).hits
    assert hits.columns == ["_id", "price", "score"]
    assert [(r["_id"], r["price"]) for r in hits.collect()] == [("2", "cheap"), ("1", "9.5")]
    counted = {r["key"]: r["doc_count"] for r in q.terms_agg(json_docs, "at.city").collect()}
    assert counted == {"Rome": 1, "Oslo": 1}
    ranges = q.ranges_agg(json_docs, "price", [q.bucket("low", to=10), q.bucket("high", 10)])
    assert {r["key"]: r["doc_count"] for r in ranges.collect()} == {"low": 1, "high": 1}


def test_mapped_fields_have_types(json_docs):
    typed = q.mapped(json_docs, "price double, tags array<string>, at struct<city: string>")
    assert ids(q.matching(typed, q.term("tags", "b"))) == ["1"]
    assert [r["_id"] for r in q.search(typed, "_id", sort=[("price", "desc")], size=2).hits.collect()] == ["3", "1"]
    assert {r["_id"]: r["price"] for r in typed.collect()} == {"1": 9.5, "2": None, "3": 20.0, "4": None, "5": None}
    with pytest.raises(ValueError):
        q.mapped(json_docs, "_ID string")


def test_boosts_scale_scores_and_contributions(spark):
    docs = spark.createDataFrame([("1", "red", 1), ("2", "blue red", 2)], "_id string, text string, n int")
    plain = q.search(docs, "_id", q.match("text", "red"), fields=[]).hits.collect()
    double = q.search(docs, "_id", q.match("text", "red", boost=2.0), fields=[], explain=True).hits.collect()
    weighted = q.search(docs, "_id", q.multi_match(["text^2"], "red"), fields=[]).hits.collect()
    assert [r["score"] for r in double] == pytest.approx([2 * r["score"] for r in plain], abs=1e-5)
    assert [r["score"] for r in weighted] == [r["score"] for r in double]
    assert double[0]["explanation"]["text:red"] == double[0]["score"]
    both = q.bool_(should=[q.term("n", 1, boost=3.0), q.terms("n", [1, 2], boost=0.5)], boost=2.0)
    assert {r["_id"]: r["score"] for r in q.search(docs, "_id", both).hits.collect()} == {"1": 7.0, "2": 1.0}


def test_minimum_of_a_multi_match(spark):
    docs = spark.createDataFrame([("1", "red blue"), ("2", "red"), ("3", None)], "_id string, text string")
    assert ids(q.matching(docs, q.multi_match(["text"], "red blue", minimum_should_match=2))) == ["1"]


def test_columns_of_hits_must_not_clash(spark):
    docs = spark.createDataFrame([("1", 5)], "_id string, Score int")
    with pytest.raises(ValueError):
        q.search(docs, "_id")
    assert q.search(docs, "_id", fields=["_id"]).hits.columns == ["_id", "score"]
    assert q.hits_count(docs, q.term("Score", 5)).first()["total"] == 1


def test_bucket_options(spark):
    docs = spark.createDataFrame([(k,) for k in "aaabbccd"], "k string")

    def keys(**options):
        one = [r["key"] for r in q.terms_agg(docs, "k", **options).collect()]
        several = q.run_aggs(docs, {"x": q.agg_terms("k", **options), "y": q.agg_terms("k", size=1)})
        assert sorted(r["key"] for r in several.where("agg = 'x'").collect()) == sorted(one)
        assert [(r["key"], r["doc_count"]) for r in several.where("agg = 'y'").collect()] == [("a", 3)]
        return one

    assert keys(size=2) == ["a", "b"]
    assert keys(size=2, order=("key", "desc")) == ["d", "c"]
    assert keys(size=3, order=("count", "asc")) == ["d", "b", "c"]
    assert keys(min_doc_count=2) == ["a", "b", "c"]
    assert keys(include=["c", "d", "z"], exclude=["d"]) == ["c"]
    with pytest.raises(ValueError):
        q.agg_terms("k", order=("size", "asc"))


def test_large_aggregations_are_ranked_in_parts(spark):
    docs = spark.range(20_000).select((F.col("id") % 7000).alias("k"))
    found = q.run_aggs(docs, {"x": q.agg_terms("k", size=5000)})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [row_number()") == 2 and "_part" in plan
    expected = docs.groupBy(F.col("k").cast("string").alias("key")).count().orderBy(F.desc("count"), "key").limit(5000)
    assert sorted(map(tuple, found.select("key", "doc_count").collect())) == sorted(map(tuple, expected.collect()))


def test_snapshots_copy_nothing(spark, tmp_path):
    store = q.Store(spark, str(tmp_path / "s"))
    store.commit(spark.range(5))
    repository = q.SnapshotRepository(spark, str(tmp_path / "repo"))
    repository.create("one", {"s": store})
    store.commit(spark.range(2))
    assert repository.restore("one", {"s": store}) == {"s": 3}
    assert store.read().count() == 5 and store.read(2).count() == 2
    assert store.folder() == store.folder(1)
    assert os.listdir(tmp_path / "repo") == ["_manifest"]
    assert store.commit(spark.range(1)) == 4 and store.read().count() == 1
