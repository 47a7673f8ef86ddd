"""Stores written bucket by bucket."""

import json
import os

import pytest

import quillspan as q
from quillspan.operators.writes import ACTION_SCHEMA
from quillspan.sources.buckets import BucketStore
from quillspan.sources.store import SnapshotRepository
from quillspan.streaming.continuous import continuous_upsert

SCHEMA = "_index string, _type string, _id string, _version bigint, a string"


@pytest.fixture(scope="module")
def current(spark):
    return spark.createDataFrame([("i", "t", str(n), 1, f"a{n}") for n in range(300)], SCHEMA)


def actions(spark, *rows):
    return spark.createDataFrame([(i, op, "i", "t", key, payload) for i, (op, key, payload) in enumerate(rows)], ACTION_SCHEMA)


def files(store):
    return {os.path.join(d, f) for d, _, names in os.walk(store.path + "/data") for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_batch_writes_the_buckets_it_touches(spark, current, tmp_path):
    store, plain = BucketStore(spark, str(tmp_path / "b"), buckets=32), q.Store(spark, str(tmp_path / "p"))
    store.commit(current)
    plain.commit(current)
    before = files(store)
    assert len(before) == len({r["bucket"] for r in current.select(store._bucket().alias("bucket")).collect()})
    batch = actions(spark, ("index", "7", '{"a": "new"}'), ("delete", "8", None), ("index", "n", '{"a": "x"}'), ("index", None, '{"a": "x"}'), ("index", "9", "no"))
    got, want = store.apply(batch), plain.apply(batch)
    assert rows(got.docs) == rows(want.docs) and rows(got.results) == rows(want.results)
    assert 1 <= len(files(store) - before) <= 4 and before <= files(store)
    assert rows(store.read(1)) == rows(current)
    assert BucketStore(spark, store.path, buckets=5).buckets == 32


def test_buckets_may_become_empty_and_full_again(spark, current, tmp_path):
    store = BucketStore(spark, str(tmp_path / "b"), buckets=2)
    store.commit(current.limit(0))
    assert store.read().count() == 0 and store.read().schema == current.schema
    assert rows(store.apply(actions(spark)).docs) == []
    assert rows(store.apply(actions(spark, ("index", "1", '{"a": "x"}'))).docs) == [("i", "t", "1", 1, "x")]
    assert rows(store.apply(actions(spark, ("delete", "1", None))).docs) == []
    assert store.latest() == 4


def test_unnamed_folders_go_and_snapshots_stay(spark, current, tmp_path):
    store = BucketStore(spark, str(tmp_path / "b"), buckets=8)
    store.commit(current)
    repository = SnapshotRepository(spark, str(tmp_path / "s"))
    repository.create("first", {"i": store})
    for n in range(3):
        store.apply(actions(spark, ("index", "1", json.dumps({"a": f"v{n}"}))))
    store._write(current.limit(3))  # a write that was never published
    before, now = files(store), rows(store.read())
    gone = store.vacuum(repositories=[repository])
    assert len(files(store)) == len(before) - len([g for g in gone if "/data/" in g])
    assert rows(store.read()) == now and store.vacuum(repositories=[repository]) == []
    with pytest.raises(Exception):
        store.read(2).collect()
    repository.restore("first", {"i": store})
    assert rows(store.read()) == rows(current)
    repository.delete("first")
    assert rows(store.read()) == rows(current) and store.latest() == 5


def test_streams_write_touched_buckets_once(spark, current, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    store = BucketStore(spark, str(tmp_path / "b"), buckets=32)
    store.commit(current)
    lines = spark.readStream.schema(ACTION_SCHEMA).json(str(folder))
    run = lambda: continuous_upsert(lines, store, str(tmp_path / "progress")).awaitTermination()
    for n in range(2):
        before = files(store)
        action = {"seq": n, "op": "index", "_index": "i", "_type": "t", "_id": str(n), "payload": json.dumps({"a": f"s{n}"})}
        (folder / f"{n}.json").write_text(json.dumps(action) + "\n")
        run()
        assert len(files(store) - before) == 1
    batch = spark.createDataFrame([(5, "index", "i", "t", "5", '{"a": "again"}')], ACTION_SCHEMA)
    before, latest = files(store), store.latest()
    store.apply(batch, version=latest)  # a version that is there is left alone
    run()
    assert files(store) == before and store.latest() == latest == 3
    assert {r["_id"]: r["a"] for r in store.read().where("_version > 1").collect()} == {"0": "s0", "1": "s1"}
