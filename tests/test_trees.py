"""Trees of aggregations against a plain fold over the rows."""

import random

import pytest

import quillspan as q


def brute(rows, splits, metric, prefix=""):
    """``{(agg, path): (count, metric)}`` level by level, with whole lists of rows."""
    out = {}
    for node in splits:
        name, by = prefix + node.name, node.by
        if hasattr(by, "buckets"):
            inside = lambda b, v: v is not None and (b.from_ is None or v >= b.from_) and (b.to is None or v < b.to)
            kept = [(b.key, [r for r in rows if inside(b, r[by.field])]) for b in by.buckets]
        else:
            held = {}
            for r in rows:
                values = r[by.field] if isinstance(r[by.field], list) else [r[by.field]]
                for v in {v for v in values if v is not None}:
                    if (by.include is None or v in by.include) and v not in by.exclude:
                        held.setdefault(str(v), []).append(r)
            found = sorted(held.items(), reverse=by.order == ("key", "desc"))
            if by.order[0] == "count":
                found.sort(key=lambda kv: len(kv[1]) if by.order[1] == "asc" else -len(kv[1]))
            kept = [kv for kv in found if len(kv[1]) >= by.min_doc_count][: by.size]
        for key, some in kept:
            out[name, (key,)] = (len(some), metric(some))
            for (agg, path), cell in brute(some, node.subs, metric, name + "/").items():
                out[agg, (key, *path)] = cell
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    rows = [
        {
            "a": rng.choice(["x", "x", "x", "y", "z", None]),
            "tags": rng.choice([None, [], ["t", "t"], ["t", "u", None], ["v", "u", "w"]]),
            "n": rng.choice([None, *range(30)]),
            "score": rng.choice([None, 1, 2, 3, 40]),
        }
        for _ in range(600)
    ]
    return rows, spark.createDataFrame([tuple(r.values()) for r in rows], "a string, tags array<string>, n int, score bigint")


RANGES = q.agg_ranges("n", [q.bucket("low", to=10), q.bucket("mid", 5, 20), q.bucket("never", 1000)])
TREES = {
    "three": [q.split("a", q.agg_terms("a", 2), q.split("n", RANGES, q.split("tag", q.agg_terms("tags", 2))))],
    "arrays": [q.split("tag", q.agg_terms("tags", 3, exclude=["w"]), q.split("again", q.agg_terms("tags", 5, order=("key", "desc"))), q.split("n", RANGES))],
    "ranges_above": [q.split("n", RANGES, q.split("a", q.agg_terms("a", 2, order=("count", "asc"), min_doc_count=40))), q.split("flat", q.agg_terms("score", 2))],
    "deep": [q.split("a", q.agg_terms("a", 1), q.split("t", q.agg_terms("tags", 2), q.split("s", q.agg_terms("score", 2, include=[1, 3, 40]), q.split("n", q.agg_terms("n", 3)))))],
}


@pytest.mark.parametrize("name", TREES)
def test_equals_a_fold_over_the_rows(data, name):
    rows, df = data
    got = q.agg_tree(df, TREES[name], {"total": ("sum", "score"), "known": ("count", "n")}).collect()
    found = {(r["agg"], tuple(r["path"])): (r["doc_count"], (r["total"], r["known"])) for r in got}
    assert len(found) == len(got)

    def metric(some):
        scores = [r["score"] for r in some if r["score"] is not None]
        return (sum(scores) if scores else None, sum(r["n"] is not None for r in some))

    assert found == brute(rows, TREES[name], metric)


def test_empty_tables_and_names(data, spark):
    _, df = data
    got = q.agg_tree(df.limit(0), TREES["ranges_above"]).collect()
    assert sorted((r["agg"], r["path"], r["doc_count"]) for r in got) == [("n", [k], 0) for k in ("low", "mid", "never")]
    with pytest.raises(ValueError):
        q.agg_tree(df, [q.split("a", q.agg_terms("a")), q.split("a", q.agg_terms("n"))])
    with pytest.raises(ValueError):
        q.split("a/b", q.agg_terms("a"))


def test_the_rows_are_read_once(data, tmp_path):
    df = data[1]
    df.write.parquet(f"{tmp_path}/rows")
    rows = df.sparkSession.read.parquet(f"{tmp_path}/rows")
    found = q.agg_tree(rows, TREES["three"])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = plan.count("FileScan parquet")
    assert scans == 1, plan
