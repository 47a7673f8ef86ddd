"""Canonical JSON against the trees that Python reads, with exact numbers."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from quillspan.functions import json as qj

VALID = [
    '{"b":1,"a":2}', '{"a":2, "b":1}', '{"a":2,"b":1.0}', '{"b":1.00,"a":2}', '{"b":10e-1,"a":2}', "1", "-1", "1.0", "1e0", "100", "1e2", "100.0",
    "1e400", "1e500", "10e399", "0", "-0", "-0.0", "0.0", "0e5", "0.1", "1E-1", "0.10", "1e-30", "12e15", "0.30000000000000004", "0.3",
    "123456789012345678901234567890.12345678901234", "123456789012345678901234567890.123456789012340", "9" * 2000, "9" * 1999 + "8",
    '"1"', '"n1"', '"s1"', '"a\\"n1\\":b"', '{"n1":"s,12","k":"\\"n3\\":"}', '"\\u00e9"', '"é"', '"\\/"', '"/"', '""', "[]", "{}", " [ ] ", "null", "[null]",
    "[[1,2],[3]]", "[[1,2,3]]", "[1,[2,3]]", "true", '"true"', '{"a":{"c":null,"b":[true,false,-3]}}', '{"a":{"b":[true,false,-3],"c":null}}', '"\\\\"', '"\\\\\\""',
    "[" * 200 + "]" * 200, "[" + "1.50," * 3000 + "1]", '{"":0}',
]
INVALID = [
    "", "zz", '{"a":NaN}', "NaN", "Infinity", '"x" y', '{"a":1} zz', "{a:1}", "{'a':1}", "01", "1.", ".5", "[1,]", "{1:2}", "1],[2", '1}, {"x":2', "1,2", "[-, 1]",
    "true1", "1 2", '"a\x01b"', '"tab\tx"', "[1] ]", "[1", '{"a":1,"a":2}', '"', "-", "+1", "1e", '{"a"}', None,
]


def tree(text):
    def number(kind):
        return lambda s: (kind, Decimal(s) + 0 if Decimal(s) else Decimal(0))

    def freeze(v):
        if isinstance(v, dict):
            return ("object", frozenset((k, freeze(x)) for k, x in v.items()))
        return ("array", tuple(freeze(x) for x in v)) if isinstance(v, list) else (type(v).__name__, v)

    import decimal

    with decimal.localcontext(decimal.Context(prec=5000, Emax=10**9, Emin=-(10**9))):
        return freeze(json.loads(text, parse_int=number("whole"), parse_float=number("real")))


def test_equal_trees_have_one_spelling_and_others_do_not(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*VALID, *INVALID])], "i int, t string")
    spelled = {r["i"]: r["c"] for r in rows.select("i", qj.canonical_json(F.col("t")).alias("c")).collect()}
    assert all(spelled[i] is None for i in range(len(VALID), len(VALID) + len(INVALID)))
    trees = [tree(t) for t in VALID]
    assert [tree(spelled[i]) for i in range(len(VALID))] == trees
    for i, a in enumerate(trees):
        for j, b in enumerate(trees[:i]):
            assert (spelled[i] == spelled[j]) == (a == b), (VALID[i], VALID[j])


def test_canonical_json_needs_no_python_worker(spark, plan):
    df = spark.createDataFrame([('{"a": 1}',)], "t string").groupBy(qj.json_hash(document=F.col("t")).alias("h")).count()
    assert "Python" not in plan(df)


def test_canonical_json_reads_a_text_once(spark, plan):
    df = spark.createDataFrame([('{"a": 1}',)], "t string").select(qj.canonical_json(F.col("t")).alias("c"))
    made = plan(df)
    assert made.count('"s$1"') == 1 and made.count("try_parse_json") <= 2


def test_equal_documents_are_read_once(spark, plan):
    from checks.archives import json_dedup, json_hash_groups
    from checks.registry import Tables

    class Events(Tables):
        def __call__(self, name):
            return self.spark.createDataFrame([(1, "a", '{"k": 1}'), (2, "a", '{"k": 1}'), (3, None, '{"k": 1}'), (4, "b", None)], "event_id bigint, event_type string, props string")

    events = Events(spark, "")
    assert sorted(r["doc"] or "" for r in json_dedup(events).collect()) == ["", '{"k":1,"t":{"a":1,"b":"a"}}', '{"k":1,"t":{"a":1.0,"b":"a"}}']
    assert sorted(map(tuple, json_hash_groups(events).collect())) == [(1, 2), (1, 4), (3, 6)]
    made = plan(json_dedup(events))
    assert made.rindex('"s$1"') < made.rindex("Aggregate")  # texts are grouped below
    assert "keys=[doc" in plan(json_hash_groups(events))
