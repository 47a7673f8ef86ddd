"""Archived responses at their edges, JSON values and geography."""

import math
import random

import pytest
from pyspark.sql import functions as F

import quillspan as q
from quillspan.functions import geo
from quillspan.functions import json as qj
from quillspan.operators import responses


def payloads(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, payload string")


def by_i(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("i").collect()]


def test_classification(spark):
    df = payloads(
        spark, None, "", "  ", "Bad Json", '{"error": "no", "status": 404}', '{"error": "no"}', "{}", '{"acknowledged": true}',
        "[1]", "null", '{"error": null}', '{"error": {"type": "x"}, "status": 500}', '{"a": ',
    )
    judged = responses.classify(df)
    assert [r[0] for r in by_i(judged, "outcome")] == [
        "invalid", "invalid", "invalid", "invalid", "error", "error", "ok", "ok", "ok", "ok", "error", "error", "invalid",
    ]
    assert by_i(judged, "error", "status")[4] == ("no", 404)
    assert by_i(judged, "error", "status")[5] == ("no", None)
    assert by_i(judged, "error", "status")[11] == ('{"type":"x"}', 500)
    allowed = [r[0] for r in by_i(responses.classify(df, allow_error=True), "outcome")]
    assert allowed[4:6] == ["ok", "ok"] and allowed[:4] == ["invalid"] * 4


def test_hits_with_little_in_them(spark):
    df = payloads(
        spark,
        '{"took": 1, "hits": {"total": 0, "max_score": null}}',
        '{"took": 1, "hits": {"total": 0, "max_score": null, "hits": []}}',
        '{"took": 1, "hits": {"total": 7, "hits": [{"_id": "a", "_score": null, "matched_queries": ["x##1##2", "y"]}]}}',
        '{"hits": {"total": 1, "hits": [{"_id": "b", "_source": {"n": 1.0, "s": [1]}, "_explanation": {"value": 2}}]}}',
    )
    hits = responses.search_hits(df).collect()
    assert [(r["i"], r["_id"], r["_index"], r["_score"], r["matched_queries"]) for r in hits] == [
        (2, "a", None, None, ["x", "y"]), (3, "b", None, None, None),
    ]
    assert hits[1]["_source"] == '{"n":1.0,"s":[1]}' and hits[1]["explanation"] == '{"value":2}'
    assert by_i(responses.search_totals(df), "total", "max_score") == [(0, None), (0, None), (7, None), (1, None)]


def test_a_listing_that_is_no_list_has_no_rows(spark):
    df = payloads(spark, None, "   ", '{"error": "x"}', "[]", '[{"index": "i", "shard": "3", "docs": ""}]')
    rows = responses.shard_listing(df).collect()
    assert [(r["i"], r["index"], r["shard"], r["docs"]) for r in rows] == [(4, "i", 3, None)]


def test_node_stats_without_disk(spark):
    df = payloads(spark, '{"nodes": {"n": {"host": "h", "fs": {"total": {}}, "attributes": {}}}}', '{"nodes": {}}')
    row = responses.node_stats(df, attributes=("zone",)).collect()
    assert [(r["host"], r["disk_used_in_bytes"], r["attribute_zone"]) for r in row] == [("h", None, None)]


def test_bulk_items_of_other_kinds(spark):
    df = payloads(spark, '{"errors": false, "items": [{"create": {"status": 201}}, {"update": {"_id": "1", "status": 429}}]}')
    assert [(r["kind"], r["_id"], r["status"]) for r in responses.bulk_items(df).collect()] == [
        ("unknown", None, None), ("update", "1", 429),
    ]


def test_worst_of_requested(spark):
    health = spark.createDataFrame([("a", "green"), ("b", "yellow"), ("c", "red")], "index string, status string")

    def worst(*names):
        asked = spark.createDataFrame([(n,) for n in names], "index string")
        return tuple(responses.worst_status(asked, health).first())

    assert worst("a") == ("green", False)
    assert worst("a", "b") == ("yellow", False)
    assert worst("a", "b", "c") == ("red", False)
    assert worst("a", "gone") == ("red", True)


def test_pages_fold_in_order(spark):
    page = "search_id int, page_no int, took bigint, total bigint, max_score double, aggregations string, error string, status int"
    rows = [
        (1, 0, 3, 10, None, "{}", None, None), (1, 1, 4, 12, 0.5, '{"x": 1}', None, None), (1, 2, 5, 11, 0.2, '{"y": 1}', None, None),
        (2, 0, 1, 1, 1.0, None, None, None), (2, 1, None, None, None, None, "first", 500), (2, 2, None, None, None, None, "second", 400),
    ]
    folded = {r["search_id"]: tuple(r)[1:] for r in q.fold_pages(spark.createDataFrame(rows, page)).collect()}
    assert folded == {1: ("ok", 12, 12, 0.5, '{"x": 1}', None, None), 2: ("error", None, None, None, None, "first", 500)}


def test_canonical_json(spark):
    texts = ['{"a": 1, "b": {"c": 2, "d": [1, 2]}}', '{"b":{"d":[1,2],"c":2},"a":1}', '{"a": 1.0}', '{"a": 1}', '{"a": "é"}', "x", None, '{"a": NaN}']
    df = payloads(spark, *texts).select("i", qj.canonical_json(F.col("payload")).alias("c"))
    c = [r[0] for r in by_i(df, "c")]
    assert c[0] == c[1] and c[2] != c[3] and c[4] == '{"a":"é"}' and c[5:] == [None, None, None]


def test_snake_case():
    assert [qj.snake_case(n) for n in ("timedOut", "a", "activePrimaryShards", "_id", "node2Name")] == [
        "timed_out", "a", "active_primary_shards", "_id", "node2_name",
    ]


@pytest.mark.parametrize("lat,lon", [(0, 0), (48.85, 2.35), (-17.5, 179.5), (65, -179.9), (89.5, 10), (-90, 0)])
@pytest.mark.parametrize("distance", ["5km", "800km", "3000mi", "30000000m"])
def test_the_box_holds_the_circle(spark, lat, lon, distance):
    r = random.Random(f"{lat}{lon}{distance}")
    points = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(300)]
    points += [(float(max(-90, min(90, lat + r.gauss(0, 3)))), (lon + r.gauss(0, 3) + 180) % 360 - 180) for _ in range(300)]
    df = spark.createDataFrame(points, "lat double, lon double")
    reach = geo.metres(distance)
    at = F.col("lat"), F.col("lon")
    row = df.select(
        (geo.haversine_m(*at, lat, lon) <= reach).alias("near"), geo.bounding_box(*at, lat, lon, reach).alias("boxed")
    )
    assert row.where("near AND NOT boxed").count() == 0


def test_distances():
    assert geo.metres("100km") == 100000 and geo.metres("2 mi") == 3218.688 and geo.metres("5m") == 5
    with pytest.raises(ValueError):
        geo.metres("5 furlongs")
    assert math.isclose(geo.EARTH_RADIUS_M, 6371008.7714)
