"""Stores, snapshots, indices, pages and streams."""

import json
import re

import pytest
from pyspark.sql import functions as F

import quillspan as q
from quillspan.operators import catalog
from quillspan.operators.aggs import is_array
from quillspan.operators.documents import bulk_apply_json
from quillspan.operators.writes import ACTION_SCHEMA
from quillspan.plans import durable
from quillspan.plans.postings import match_postings, read_postings, write_postings
from quillspan.plans.rowindex import with_row_index
from quillspan.sources import readers
from quillspan.streaming.continuous import (
    continuous_upsert,
    keep_updates,
    latest_counts,
    standing_query,
    windowed_terms,
)

DOCS = "_index string, _type string, _id string, _version bigint, a string"


@pytest.fixture
def current(spark):
    return spark.createDataFrame([("i", "t", str(n), 1, f"v{n}") for n in range(5)], DOCS)


def test_versions(spark, current, tmp_path):
    store = q.Store(spark, str(tmp_path / "s"))
    assert store.latest() is None
    with pytest.raises(ValueError):
        store.read()
    assert store.commit(current) == 1
    assert store.commit(current.limit(2)) == 2
    assert (store.read().count(), store.read(1).count()) == (2, 5)
    assert store.commit(current, version=2) == 2 and store.read().count() == 2
    actions = spark.createDataFrame([(0, "index", "i", "t", "9", '{"a": "x"}')], ACTION_SCHEMA)
    outcome = store.apply(actions)
    assert store.latest() == 3
    assert outcome.docs.count() == 3 and [r["status"] for r in outcome.results.collect()] == [201]


def test_snapshots(spark, current, tmp_path):
    stores = {n: q.Store(spark, str(tmp_path / n)) for n in ("one", "two")}
    for store in stores.values():
        store.commit(current)
    repository = q.SnapshotRepository(spark, str(tmp_path / "repo"))
    repository.create("all", stores)
    repository.create("part", stores, ["two"])
    with pytest.raises(ValueError):
        repository.create("all", stores)
    listed = {r["snapshot"]: (sorted(r["indices"]), r["state"]) for r in repository.list().collect()}
    assert listed == {"all": (["one", "two"], "SUCCESS"), "part": (["two"], "SUCCESS")}
    stores["two"].commit(current.limit(1))
    assert repository.restore("part", stores) == {"two": 3}
    assert stores["two"].read().count() == 5 and stores["one"].latest() == 1
    repository.delete("all")
    assert repository.list().where("snapshot = 'all'").first()["state"] == "DELETED"
    with pytest.raises(ValueError):
        repository.restore("all", stores)


def test_create_and_delete_index(spark):
    q.create_index(spark, "made_here", "a string, b int", {"shards": 3, "note": "it's"})
    assert spark.table("made_here").columns == ["a", "b"]
    properties = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES made_here").collect()}
    assert properties["shards"] == "3" and properties["note"] == "it's"
    q.delete_index(spark, "made_here")
    assert not spark.catalog.tableExists("made_here")


def test_row_index_and_pages(spark):
    df = spark.range(0, 1003).select(F.col("id").alias("_id"), (F.col("id") % 3).alias("k")).repartition(7)
    paged = q.pages(df, [("k", "desc")], size=100)
    rows = [(r["row_index"], r["page_no"], r["k"], r["_id"]) for r in paged.orderBy("row_index").collect()]
    assert [r[0] for r in rows] == list(range(1003))
    assert [r[1] for r in rows] == [i // 100 for i in range(1003)]
    assert [(r[2], r[3]) for r in rows] == sorted(((i % 3, i) for i in range(1003)), key=lambda t: (-t[0], t[1]))
    sizes = [len(page) for page in q.iter_pages(paged)]
    assert sizes == [100] * 10 + [3]
    assert list(q.iter_pages(q.pages(df.where("false"), [("k", "desc")]))) == []
    plain = with_row_index(df, [F.col("_id").asc()], "at")
    assert plain.where("at <> _id").count() == 0


def test_written_pages_hold_at_most_their_size(spark, tmp_path):
    df = spark.range(0, 250).select(F.col("id").alias("_id"))
    q.write_pages(df, str(tmp_path / "pages"), [("_id", "asc")], size=40)
    files = spark.read.parquet(str(tmp_path / "pages")).groupBy(F.input_file_name().alias("f")).count()
    assert files.agg(F.max("count")).first()[0] <= 40 and files.agg(F.sum("count")).first()[0] == 250


def test_ids(spark, current):
    assert q.multi_get(current, []).collect() == []
    got = {r["_id"]: (r["found"], r["a"], r["error"]) for r in q.multi_get(current, ["1", "1", "7"], fields=["a"]).collect()}
    assert got == {"1": (True, "v1", None), "7": (False, None, "not found")}
    assert q.multi_get(current, ["1"], type_name="other").first()["found"] is False
    both = current.unionByName(current.withColumn("_type", F.lit("a")).withColumn("a", F.lit("first")))
    assert q.get(both, "3").first()["a"] == "first"
    missing = q.get(current, "70").first()
    assert (missing["found"], missing["_version"]) == (False, None)


def test_array_documents_count_once_per_value(spark):
    df = spark.createDataFrame([(["x", "x", None],), (["x", "y"],), ([],), (None,)], "l array<string>")
    assert is_array(df, "l")
    assert [tuple(r) for r in q.terms_agg(df, "l").collect()] == [("x", 2), ("y", 1)]
    rows = q.run_aggs(df, {"one": q.agg_terms("l", size=1)}).collect()
    assert [tuple(r) for r in rows] == [("one", "x", 2)]
    other = q.terms_agg(df, "l", size=1, sum_other=True).first()
    assert other["sum_other_doc_count"] == 1


def test_aliases_change_in_order(spark):
    def rows(*data):
        return spark.createDataFrame([(*d, None) for d in data], catalog.ALIAS_SCHEMA)

    now = rows(("i", "a", None), ("j", "a", None))
    after = catalog.modify_aliases(now, rows(("i", "a", "new"), ("k", "b", None)), rows(("j", "a", None), ("k", "b", None)))
    assert sorted((r["index"], r["alias"], r["index_routing"]) for r in after.collect()) == [("i", "a", "new")]
    with pytest.raises(ValueError):
        catalog.read_alias(now, "none", {})


def test_typed_mappings(spark, current):
    nested = spark.createDataFrame([((1, "x"),)], "o struct<n: int, s: string>")
    rows = catalog.mappings({"i": current, "j": nested}, ["j", "j", "absent"]).collect()
    assert [(r["index"], r["field"], r["data_type"]) for r in rows] == [("j", "o.n", "int"), ("j", "o.s", "string")]


def test_written_postings_give_the_scores_of_a_scan(spark, tmp_path, plan):
    docs = spark.createDataFrame([(1, "the cat the dog"), (2, "a dog"), (3, None), (4, "cat")], "id int, t string")
    write_postings(docs, "id", "t", str(tmp_path / "p"), buckets=5)
    stored = read_postings(spark, str(tmp_path / "p"))
    for operator in ("or", "and"):
        scan = q.search(docs, "id", query=q.match("t", "cat dog", operator=operator), size=None, fields=["id"]).hits
        assert sorted(map(tuple, match_postings(stored, "cat dog", operator).collect())) == sorted(map(tuple, scan.collect()))
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan(match_postings(stored, "cat")))


def test_json_documents_are_read_as_text(spark, tmp_path):
    path = tmp_path / "docs.json"
    path.write_text('{"id": "a", "n": 1.0}\n\n{"id": "b"}\n')
    docs = readers.read_json_documents(spark, str(path), "i", "t", "id")
    assert sorted((r["_id"], r["_source"]) for r in docs.collect()) == [("a", '{"id": "a", "n": 1.0}'), ("b", '{"id": "b"}')]


def test_small_scans_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    scan = spark.read.parquet(str(tmp_path / "one"))
    assert readers.spread(scan, 4).rdd.getNumPartitions() == 4
    assert readers.spread(scan, 1) is scan


def test_shared_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert durable.shared_dir(spark) == (named or durable.shared_dir(spark))
    assert durable.new_folder(spark, "x") != durable.new_folder(spark, "x")


def write_lines(folder, name, rows):
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


@pytest.mark.parametrize("kind", ["typed", "json"])
def test_continuous_upserts_can_be_repeated(spark, current, tmp_path, kind):
    folder = tmp_path / "in"
    folder.mkdir()
    docs = current if kind == "typed" else current.select(
        "_index", "_type", "_id", "_version", F.to_json(F.struct("a")).alias("_source")
    )
    apply = q.bulk_apply if kind == "typed" else bulk_apply_json
    store = q.Store(spark, str(tmp_path / "store"))
    store.commit(docs)
    action = {"op": "index", "_index": "i", "_type": "t"}
    write_lines(folder, "1.json", [{"seq": 1, "_id": "1", "payload": '{"a": "new"}', **action}])
    actions = spark.readStream.schema(ACTION_SCHEMA).json(str(folder))

    def run():
        continuous_upsert(actions, store, str(tmp_path / "progress"), apply=apply).awaitTermination()

    run()
    assert store.latest() == 2
    write_lines(folder, "2.json", [{"seq": 2, "_id": "9", "payload": '{"a": "x"}', **action}])
    run()
    run()
    assert store.latest() == 3
    versions = {r["_id"]: r["_version"] for r in store.read().collect()}
    assert versions == {"0": 1, "1": 2, "2": 1, "3": 1, "4": 1, "9": 1}


def test_streams_pass_no_batch_over(spark, current, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    actions = spark.readStream.schema(ACTION_SCHEMA).json(str(folder))
    store = q.Store(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError):
        continuous_upsert(actions, store, str(tmp_path / "progress"))
    for _ in range(3):
        store.commit(current)
    write_lines(folder, "1.json", [{"seq": 1, "op": "index", "_index": "i", "_type": "t", "_id": "9", "payload": '{"a": "x"}'}])
    for name in ("progress", "other"):
        continuous_upsert(actions, store, str(tmp_path / name)).awaitTermination()
    assert store.latest() == 5 and store.read(4).count() == 6


def test_standing_query_and_windows(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "ts timestamp, kind string, text string"
    write_lines(folder, "1.json", [
        {"ts": "2024-01-01T00:01:00Z", "kind": "a", "text": "big fire"},
        {"ts": "2024-01-01T00:02:00Z", "kind": "a", "text": "rain"},
        {"ts": "2024-01-01T01:02:00Z", "kind": "b", "text": "Fire!"},
        {"ts": "2024-01-01T03:00:00Z", "kind": "c", "text": "x"},
    ])
    stream = spark.readStream.schema(schema).json(str(folder))
    alerts = standing_query(stream, q.match("text", "fire"))
    out = alerts.writeStream.format("memory").queryName("alerts").trigger(availableNow=True).start()
    out.awaitTermination()
    assert spark.table("alerts").count() == 2
    counts = windowed_terms(stream, "ts", "kind", "1 hour", "10 minutes")

    def run():
        keep_updates(counts, str(tmp_path / "counts"), str(tmp_path / "progress")).awaitTermination()
        return {(str(r["window_start"])[11:13], r["key"]): r["doc_count"] for r in latest_counts(spark, str(tmp_path / "counts")).collect()}

    assert run() == {("00", "a"): 2, ("01", "b"): 1, ("03", "c"): 1}
    write_lines(folder, "2.json", [
        {"ts": "2024-01-01T03:05:00Z", "kind": "c", "text": "x"},
        {"ts": "2024-01-01T00:03:00Z", "kind": "a", "text": "too late"},
    ])
    assert run() == {("00", "a"): 2, ("01", "b"): 1, ("03", "c"): 2}
