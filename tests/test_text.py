"""Tokens, offsets and searching in place."""

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspan.functions import text as ta

LETTERS = "ab'_ é1.́"
SAMPLES = [
    "Hello, World", "don't  stop", "'quoted' text", "a''b", "x_'y", "naïve façade — déjà vu", "",
    None, "日本 語", "😀 smile😀d", "tab\tand\nline", "rock'n'roll", "1st 2nd_3", "\u0001 mark", "end'",
]


def test_tokens_and_offsets(spark):
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "i int, t string")
    rows = df.select("i", "t", ta.tokens(F.col("t")).alias("w"), ta.analyze(F.col("t")).alias("a")).collect()
    for r in rows:
        source = r["t"] or ""
        assert r["w"] == ta.query_tokens(source)
        assert [a["token"] for a in r["a"]] == r["w"]
        assert [a["position"] for a in r["a"]] == list(range(1, len(r["w"]) + 1))
        for a in r["a"]:
            assert source[a["start_offset"] : a["end_offset"]].lower() == a["token"]


def test_token_counts(spark):
    from collections import Counter

    df = spark.createDataFrame([(t,) for t in ["b a b c a b", "", "one", "z z z"]], "t string")
    rows = df.select("t", F.array_sort(ta.tokens(F.col("t"))).alias("s")).select("t", ta.token_counts("s").alias("c"))
    for r in rows.collect():
        assert {c["token"]: c["tf"] for c in r["c"] or []} == Counter(r["t"].split())


def test_edge_ngrams(spark):
    df = spark.createDataFrame([("Quick it",)], "t string")
    grams = df.select(ta.edge_ngrams(ta.tokens(F.col("t")), 2, 3).alias("g")).first()["g"]
    assert grams == ["qu", "qui", "it"]


words = st.text(alphabet="ab1_é", min_size=1, max_size=3)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=LETTERS, max_size=14), st.lists(words, min_size=1, max_size=3))
def test_searching_in_place_equals_looking_through_tokens(text, raw_terms):
    """The search patterns use only what Java and the regex module read alike."""
    terms = [t for w in raw_terms for t in ta.query_tokens(w)]
    if not terms:
        return
    found = ta.query_tokens(text)
    low = text.lower()
    assert bool(regex.search(ta.any_regex(terms), low)) == any(t in found for t in terms)
    assert bool(regex.search(ta.every_regex(terms), low)) == all(t in found for t in terms)
    n = len(terms)
    runs = [found[i : i + n] for i in range(len(found) - n + 1)]
    assert bool(regex.search(ta.run_regex(terms), low)) == (terms in runs)
    begun = any(r[:-1] == terms[:-1] and r[-1].startswith(terms[-1]) for r in runs)
    assert bool(regex.search(ta.run_regex(terms, True), low)) == begun


def test_patterns_mean_the_same_in_spark(spark):
    texts = ["a'b c", "a 'b' c", "b_'a", "ab, a b", "a.b", "a  b'", "é á b", "b'a'b", "a_b a b1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for terms in (["a"], ["a", "b"], ["b", "c"], ["a'b"], ["b"], ["a_b"]):
        row = df.select(
            "t",
            ta.tokens(F.col("t")).alias("w"),
            F.lower("t").rlike(ta.any_regex(terms)).alias("any"),
            F.lower("t").rlike(ta.every_regex(terms)).alias("every"),
            F.lower("t").rlike(ta.run_regex(terms)).alias("run"),
            ta.holds_run(ta.tokens(F.col("t")), terms).alias("stored_run"),
        )
        for r in row.collect():
            assert r["any"] == any(t in r["w"] for t in terms), r
            assert r["every"] == all(t in r["w"] for t in terms), r
            assert r["run"] == r["stored_run"], r


def test_unknown_analyzer(spark):
    with pytest.raises(ValueError):
        ta.analyzed(F.lit("x"), "nonsense")
