"""Pages without an order, ids held by several types, ids of another type, and unusual sequence numbers."""

import quillspan as q
from quillspan.operators.catalog import mappings
from quillspan.operators.writes import ACTION_SCHEMA


def test_from_counts_without_an_order_and_without_a_size(spark, plan):
    rows = spark.range(1000).selectExpr("cast(id AS string) AS _id", "id AS n")
    unsorted = q.search(rows, size=None, from_=990).hits
    assert unsorted.count() == 10
    ordered = q.search(rows, size=None, from_=990, sort=[("n", "asc")]).hits
    assert [r["n"] for r in ordered.collect()] == list(range(990, 1000))
    assert "CollectLimit" not in plan(ordered) and "GlobalLimit" not in plan(ordered)


def test_deep_page_has_no_row_number(spark):
    rows = spark.range(150_000).selectExpr("cast(id AS string) AS _id", "id AS n", "id AS _row")
    hits = q.search(rows, size=5, from_=120_000, sort=[("n", "asc")]).hits
    assert hits.columns == ["_id", "n", "_row", "score"]
    assert [r["n"] for r in hits.collect()] == list(range(120_000, 120_005))


def test_multi_get_reads_one_document_per_id(spark):
    rows = spark.createDataFrame(
        [("1", "b", 10), ("1", "a", 20), ("x", "a", 30), (None, "a", 40)], "_id string, _type string, v int"
    )
    for ids in ([1, 7, "x"], spark.createDataFrame([("1",), ("7",), ("x",), ("1",)], "k string")):
        got = {r["_id"]: (r["found"], r["_type"], r["v"], r["error"]) for r in q.multi_get(rows, ids).collect()}
        assert got == {"1": (True, "a", 20, None), "x": (True, "a", 30, None), "7": (False, None, None, "not found")}
    assert q.multi_get(rows, ["1"], type_name="b").first()["v"] == 10


def test_sequence_numbers_below_zero(spark):
    stored = spark.createDataFrame([("i", "t", "1", 3, 5)], "_index string, _type string, _id string, _version bigint, n bigint")
    actions = [(-5, "index", "i", "t", "1", '{"n": 6}'), (-1, "index", "i", "t", "1", '{"n": 7}'), (0, "index", "i", "t", "2", '{"n": 1}')]
    done = q.bulk_apply(stored, spark.createDataFrame(actions, ACTION_SCHEMA))
    assert {(r["_id"], r["_version"], r["n"]) for r in done.docs.collect()} == {("1", 5, 7), ("2", 1, 1)}
    results = {r["seq"]: (r["status"], r["_version"]) for r in done.results.collect()}
    assert results == {-5: (200, 4), -1: (200, 5), 0: (201, 1)}


def test_mappings_of_no_tables(spark):
    assert mappings({}).count() == 0
