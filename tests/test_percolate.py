"""Many standing queries against one filter each."""

import random

import quillspan as q
from quillspan.streaming.percolate import QUERY_SCHEMA, percolate, standing_queries

WORDS = [f"w{i}" for i in range(40)]


def tables(spark, n_queries):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choices(WORDS, k=rnd.choice([0, 3, 20]))), rnd.choice(["a", "b", None]), rnd.choice([["x"], ["x", "y"], [], None]), rnd.choice([1.0, 5.0, None])) for i in range(120)]
    queries = []
    for i in range(n_queries):
        required = [("text", w) for w in rnd.sample(WORDS, rnd.choice([1, 1, 2]))] + rnd.choice([[], [("kind", "a")], [("tags", "y")]])
        excluded = rnd.choice([None, [], [("text", rnd.choice(WORDS))], [("tags", "x")]])
        ranges = rnd.choice([None, [], [("size", 2.0, None)], [("size", None, 5.0)], [("size", 1.0, 5.0)]])
        queries.append((f"q{i}", required, excluded, ranges))
    return spark.createDataFrame(docs, "id int, text string, kind string, tags array<string>, size double"), queries


def clause(required, excluded, ranges):
    one = lambda f, v: q.match("text", v) if f == "text" else q.terms(f, [v])
    must = [one(f, v) for f, v in required]
    for f, low, high in ranges or []:
        must += [q.range_(f, ("gte", low))] if low is not None else []
        must += [q.range_(f, ("lt", high))] if high is not None else []
    return q.bool_(must=must, must_not=[one(f, v) for f, v in excluded or []])


def test_queries_as_rows_equal_single_filters(spark, plan):
    docs, queries = tables(spark, 25)
    want = sorted((r["id"], name) for name, *parts in queries for r in q.matching(docs, clause(*parts)).select("id").collect())
    found = percolate(docs, spark.createDataFrame(queries, QUERY_SCHEMA), "id", ["text"], ["kind", "tags"], ["size"])
    assert want and sorted(map(tuple, found.collect())) == want
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)


def test_thousands_of_queries_in_one_stream(spark, tmp_path):
    docs, queries = tables(spark, 3000)
    queries += [("none", [], None, None), ("null", None, None, None)]
    asked = spark.createDataFrame(queries, QUERY_SCHEMA)
    for part in range(2):
        docs.where(f"id % 2 = {part}").write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 4).parquet(str(tmp_path / "in"))
    for _ in range(2):  # a second run finds nothing new
        standing_queries(stream, asked, str(tmp_path / "out"), str(tmp_path / "progress"), "id", ["text"], ["kind", "tags"], ["size"]).awaitTermination()
    got = sorted((r["id"], r["query_id"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted(map(tuple, percolate(docs, asked, "id", ["text"], ["kind", "tags"], ["size"]).collect()))
    sample = [(name, parts) for name, *parts in queries[::300]]
    for name, parts in sample:
        if parts[0]:
            want = sorted(r["id"] for r in q.matching(docs, clause(*parts)).select("id").collect())
            assert [i for i, n in got if n == name] == want
