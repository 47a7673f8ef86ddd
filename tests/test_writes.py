"""Write batches against a plain fold, with hot documents forced into pieces."""

import json
import random

import pytest
from pyspark.sql import functions as F

import quillspan as q
from quillspan.operators import writes
from quillspan.operators.writes import ACTION_SCHEMA
from quillspan.plans.runs import chunked, last_before, running_sum, split_hot

DOCS = "_index string, _type string, _id string, _version bigint, a string, n bigint"


def fold(stored, actions, scripts, merge):
    """The rules of a batch, one action after another."""
    docs = {k: [v, d] for k, (v, d) in stored.items()}
    out = {}
    phase = {"index": 0, "delete": 1, "script": 2}

    def valid(a):
        seq, op, index, type_name, id_value, payload = a
        if not (index and type_name and id_value):
            return False
        if op == "index":
            try:
                return isinstance(json.loads(payload or ""), dict)
            except ValueError:
                return False
        return op == "delete" or bool(payload)

    for a in sorted(actions, key=lambda a: (phase[a[1]], a[0])):
        seq, op, *key, payload = a
        key = tuple(key)
        if not valid(a):
            out[seq] = (None, 400, None, "invalid action")
        elif op == "index":
            if key not in docs:
                docs[key] = [1, merge({}, json.loads(payload))]
                out[seq] = (1, 201, None, None)
            else:
                version, doc = docs[key]
                after = merge(doc, json.loads(payload))
                if json.dumps(after, sort_keys=True) != json.dumps(doc, sort_keys=True):
                    version += 1
                docs[key] = [version, after]
                out[seq] = (version, 200, None, None)
        elif op == "delete":
            if key in docs:
                out[seq] = (docs.pop(key)[0] + 1, 200, True, None)
            else:
                out[seq] = (None, 404, False, None)
        elif payload not in scripts:
            out[seq] = (None, 400, None, "unknown script")
        elif key in docs:
            docs[key] = [docs[key][0] + 1, scripts[payload](docs[key][1])]
            out[seq] = (docs[key][0], 200, None, None)
        else:
            out[seq] = (None, 404, None, "document missing")
    return docs, out


def typed_merge(doc, patch):
    return {"a": None, "n": None} | doc | {k: v for k, v in patch.items() if k in ("a", "n")}


def json_merge(doc, patch):
    if not isinstance(patch, dict):
        return patch
    out = dict(doc) if isinstance(doc, dict) else {}
    for k, v in patch.items():
        out[k] = json_merge(out.get(k), v) if isinstance(v, dict) else v
    return out


def random_batch(seed, payloads, names, size=220):
    r = random.Random(seed)
    actions = []
    for seq in range(size):
        # One document takes about half of all actions.
        id_value = "hot" if r.random() < 0.5 else r.choice(["a", "b", "c", "d", ""])
        op = r.choices(["index", "script", "delete"], [8, 3, 0.1 if id_value == "hot" else 1])[0]
        if op == "index":
            payload = r.choice(payloads)
        else:
            payload = r.choice(names) if op == "script" else None
        actions.append((seq, op, "i", "t", id_value, payload))
    r.shuffle(actions)
    return actions


def results_of(rows):
    return {r["seq"]: (r["_version"], r["status"], r["found"], r["error"]) for r in rows}


@pytest.mark.parametrize("seed,chunk", [(1, 7), (2, 40), (3, 10**6)])
def test_typed_batches(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(writes, "SCRIPTS_PER_ROUND", 9 if chunk == 7 else 1000)
    payloads = [
        '{"a": "x"}', '{"a": "x", "n": 1}', '{"n": 2}', '{"a": null}', '{"other": 3}', "{}", "", "not json", "[1]", '{"a":"y"}'
    ]
    actions = random_batch(seed, payloads, ["plus", "tail", "absent"])
    stored = {("i", "t", "hot"): (5, {"a": "z", "n": 0}), ("i", "t", "keep"): (1, {"a": "k", "n": 9}), ("i", "t", "b"): (2, {"a": None, "n": None})}
    scripts = {
        "plus": lambda d: d | {"n": None if d["n"] is None else d["n"] * 2 + 1 if d["n"] < 10**6 else 0},
        "tail": lambda d: d | {"a": ((d["a"] or "") + "!")[-5:], "n": 1},
    }
    spark_scripts = {
        "plus": lambda d: {"n": F.when(d["n"] < 10**6, d["n"] * 2 + 1).when(d["n"].isNotNull(), 0)},
        "tail": lambda d: {"a": F.right(F.concat(F.coalesce(d["a"], F.lit("")), F.lit("!")), F.lit(5)), "n": F.lit(1)},
    }
    docs, out = fold(stored, actions, scripts, typed_merge)
    for seq, op, *_, payload in actions:
        if payload == '{"other": 3}' and out[seq][1] < 400:
            out[seq] = (*out[seq][:3], "unknown fields: other")
    current = spark.createDataFrame([(*k, v, d["a"], d["n"]) for k, (v, d) in stored.items()], DOCS)
    done = q.bulk_apply(current, spark.createDataFrame(actions, ACTION_SCHEMA), spark_scripts, chunk=chunk)
    assert results_of(done.results.collect()) == out
    got = {(r["_index"], r["_type"], r["_id"]): [r["_version"], {"a": r["a"], "n": r["n"]}] for r in done.docs.collect()}
    assert got == docs


@pytest.mark.parametrize("seed,chunk", [(11, 7), (13, 10**6)])
def test_json_batches(spark, seed, chunk):
    payloads = [
        '{"a": {"b": 1}}', '{"a": {"b": {"c": 2}}}', '{"a": 5}', '{"a": {}}', '{"a": null}', '{"l": [1, 2]}',
        '{"a": {"b": 1.0}}', '{"a": {"x": {"y": "é"}}, "n": true}', "{}", "", '{"n": 1}',
    ]
    actions = random_batch(seed, payloads, ["wipe"])
    stored = {("i", "t", "hot"): (5, {"a": {"z": [1]}}), ("i", "t", "keep"): (1, {"k": 1}), ("i", "t", "b"): (2, {})}
    docs, out = fold(stored, actions, {"wipe": lambda d: {"w": 1}}, json_merge)
    current = spark.createDataFrame(
        [(*k, v, json.dumps(d)) for k, (v, d) in stored.items()],
        "_index string, _type string, _id string, _version bigint, _source string",
    )
    scripts = {"wipe": lambda d: {"_source": F.lit('{"w": 1}')}}
    done = q.bulk_apply_json(current, spark.createDataFrame(actions, ACTION_SCHEMA), scripts, chunk=chunk)
    assert results_of(done.results.collect()) == out
    got = {
        (r["_index"], r["_type"], r["_id"]): [r["_version"], json.dumps(json.loads(r["_source"]), sort_keys=True)]
        for r in done.docs.collect()
    }
    assert got == {k: [v, json.dumps(d, sort_keys=True)] for k, (v, d) in docs.items()}


def test_struct_columns_merge_field_by_field(spark):
    ddl = "_index string, _type string, _id string, _version bigint, acc struct<a: int, b: int, in: struct<c: string>>"
    current = spark.createDataFrame([("i", "t", "1", 1, (1, 2, ("x",))), ("i", "t", "2", 1, None), ("i", "t", "3", 1, (1, 2, ("x",)))], ddl)
    batch = [
        ("1", '{"acc": {"a": 9}}'), ("1", '{"acc": {"in": {"c": "y"}}}'), ("1", '{"acc": {"a": "abc"}}'), ("1", '{"acc": 5}'),
        ("1", '{"acc": {"zz": 1, "in": {"yy": 2}}, "top": 0}'), ("2", '{"acc": {"in": {}}}'), ("3", '{"acc": null}'), ("3", '{"acc": {"b": 7}}'), ("4", "{}"),
    ]
    actions = spark.createDataFrame([(n, "index", "i", "t", i, p) for n, (i, p) in enumerate(batch)], ACTION_SCHEMA)
    done = q.bulk_apply(current, actions)
    got = {r["_id"]: (r["_version"], r["acc"] and r["acc"].asDict(True)) for r in done.docs.collect()}
    assert got == {
        "1": (3, {"a": 9, "b": 2, "in": {"c": "y"}}), "2": (2, {"a": None, "b": None, "in": {"c": None}}),
        "3": (3, {"a": None, "b": 7, "in": None}), "4": (1, None),
    }
    out = results_of(done.results.collect())
    misfit = (None, 400, None, "value does not fit its column")
    assert out[2] == out[3] == misfit
    assert out[4] == (3, 200, None, "unknown fields: acc.in.yy, acc.zz, top")
    assert [out[n][1] for n in (0, 1, 5, 6, 7, 8)] == [200] * 5 + [201]


ODD = [
    '{"a": "x"} zz', "{'a': 1}", '{"a": "x"}],[3', '{"a": "x"}, "b": 3', '{"a": "x"}}', '{"n": NaN}', '{"a": "x", "a": "y"}',
    '{"a":' * 1200 + "1" + "}" * 1200,
]


@pytest.mark.parametrize("kind", ["typed", "json"])
def test_malformed_payloads_are_rejected_one_by_one(spark, kind):
    apply = q.bulk_apply if kind == "typed" else q.bulk_apply_json
    current = spark.createDataFrame([], DOCS if kind == "typed" else "_index string, _type string, _id string, _version bigint, _source string")
    batch = [(n, "index", "i", "t", "1", p) for n, p in enumerate([*ODD, '{"a": "good"}'])]
    done = apply(current, spark.createDataFrame(batch, ACTION_SCHEMA))
    out = results_of(done.results.collect())
    assert out == {n: (None, 400, None, "invalid action") for n in range(len(ODD))} | {len(ODD): (1, 201, None, None)}


def test_misfits_of_typed_columns_keep_the_stored_value(spark):
    current = spark.createDataFrame([("i", "t", "1", 3, "a", 1)], DOCS)
    done = q.upsert(current, "i", "t", "1", '{"n": "abc", "a": "new"}')
    assert results_of(done.results.collect()) == {0: (None, 400, None, "value does not fit its column")}
    assert done.docs.collect() == current.collect()


def test_json_numbers_and_deep_documents_keep_their_spelling(spark):
    stored = '{"x":0.12345678901234567890123,"y":1e400,"z":' + "9" * 5000 + ',"s":"\\ud800"}'
    deep = '{"a":' * 990 + "1" + "}" * 990
    current = spark.createDataFrame([("i", "t", "1", 1, stored)], "_index string, _type string, _id string, _version bigint, _source string")
    batch = [(0, "index", "i", "t", "1", '{"k":1.50}'), (1, "index", "i", "t", "1", '{"k":1.5}'), (2, "index", "i", "t", "2", deep), (3, "index", "i", "t", "1", '{"y":1e500}')]
    done = q.bulk_apply_json(current, spark.createDataFrame(batch, ACTION_SCHEMA))
    docs = {r["_id"]: (r["_version"], r["_source"]) for r in done.docs.collect()}
    assert docs["2"] == (1, deep)
    assert docs["1"] == (3, '{"x":0.12345678901234567890123,"y":1e500,"z":' + "9" * 5000 + ',"s":"?","k":1.5}')


@pytest.mark.parametrize("kind", ["typed", "json"])
def test_hot_keys_with_sparse_sequence_numbers_are_cut(spark, kind):
    rows = spark.createDataFrame([("h", n * 10_000_000, 1) for n in range(200)], "k string, seq bigint, v int")
    assert chunked(rows, ["k"], "seq", 50).groupBy("_chunk").count().where("count <= 50").count() == 4
    apply = q.bulk_apply if kind == "typed" else q.bulk_apply_json
    current = spark.createDataFrame([], DOCS if kind == "typed" else "_index string, _type string, _id string, _version bigint, _source string")
    batch = [(n * 10_000_000 - 10**9, "index", "i", "t", "hot", json.dumps({"n": n})) for n in range(200)]
    done = apply(current, spark.createDataFrame(batch, ACTION_SCHEMA), chunk=50)
    assert [r["_version"] for r in done.docs.collect()] == [200]
    assert sorted(r["_version"] for r in done.results.collect()) == list(range(1, 201))


def test_empty_batch_changes_nothing(spark):
    current = spark.createDataFrame([("i", "t", "1", 3, "a", 1)], DOCS)
    done = q.bulk_apply(current, spark.createDataFrame([], ACTION_SCHEMA))
    assert done.results.count() == 0
    assert done.docs.collect() == current.collect()
    assert q.batch_errors(done.results).first()["errors"] is False


def test_upsert_with_an_empty_argument_is_rejected(spark):
    current = spark.createDataFrame([("i", "t", "1", 3, "a", 1)], DOCS)
    empty = [("", "t", "1", "{}"), ("i", "", "1", "{}"), ("i", "t", "", "{}"), ("i", "t", "1", ""), ("i", None, "1", "{}")]
    batch = spark.createDataFrame([(n, "index", *args) for n, args in enumerate(empty)], ACTION_SCHEMA)
    done = q.bulk_apply(current, batch)
    assert [r["status"] for r in done.results.collect()] == [400] * 5
    assert done.docs.collect() == current.collect()
    done = q.upsert(current, "i", "t", "2", '{"a": "new"}')
    assert results_of(done.results.collect()) == {0: (1, 201, None, None)}
    assert q.batch_errors(done.results).first()["errors"] is False


def test_runs_in_pieces_equal_runs_in_windows(spark):
    r = random.Random(5)
    rows = [(r.choice(["h", "h", "h", "x", "y"]), i, r.choice([None, None, 1, 2, 3])) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, seq bigint, v int")
    for chunk in (1, 8, 50, 1000):
        for run, value in ((last_before, F.col("v")), (running_sum, F.coalesce("v", F.lit(0)))):
            whole = run(df, ["k"], "seq", {"out": value}).select("k", "seq", "out")
            pieces = run(df, ["k"], "seq", {"out": value}, chunk).select("k", "seq", "out")
            assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, pieces.collect()))
    assert [tuple(r) for r in split_hot(df, ["k"], 100).collect()] == [("h",)]
    assert split_hot(df, ["k"], 200) is None


def test_attempts(spark):
    rows = [
        (1, 1, 200, "a"), (2, 1, 429, "a"), (2, 2, 429, "b"), (2, 3, 500, "c"),
        (3, 1, 429, "a"), (3, 2, None, "lost"), (4, 1, 429, "a"),
        *[(5, n, 429, f"t{n}") for n in range(1, 8)], (5, 8, 200, "late"),
    ]
    log = spark.createDataFrame(rows, "seq int, attempt int, status int, note string")
    final = {r["seq"]: (r["attempt"], r["status"]) for r in q.merge_attempts(log, ["seq"]).collect()}
    assert final == {1: (1, 200), 2: (3, 500), 3: (1, 429), 4: (1, 429), 5: (5, 429)}


def test_delete_by_query_defaults_to_all_and_does_not_shuffle(spark, plan):
    docs = spark.createDataFrame([("i", 1), ("i", None), ("j", 2)], "_index string, n int")
    survivors, stats = q.delete_by_query(docs)
    assert survivors.count() == 0
    assert {r["_index"]: r["total"] for r in stats.collect()} == {"i": 2, "j": 1}
    survivors, _ = q.delete_by_query(docs, q.range_("n", ("gt", 1)))
    assert sorted(r["_index"] for r in survivors.collect()) == ["i", "i"]
    assert "Exchange" not in plan(survivors)
