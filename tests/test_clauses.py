"""Clause construction: what is dropped, what is combined and how missing values count."""

import pytest
from pyspark.sql import functions as F

import quillspan as q
from quillspan.operators.clauses import required_matches


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "a", 10, ["x", "y"], "red fox"),
        (2, "b", 20, ["y"], "red red"),
        (3, None, 30, [], None),
        (4, "ab", None, None, "The fox's den"),
    ]
    return spark.createDataFrame(rows, "_id bigint, tag string, n int, labels array<string>, body string")


def ids(df, *clauses):
    return sorted(r["_id"] for r in q.matching(df, list(clauses)).collect())


def test_clauses_that_ask_for_nothing_are_dropped():
    assert q.prefix("tag", "") is None
    assert q.match("body", "") is None
    assert q.phrase("body", "") is None
    assert q.phrase_prefix("body", "") is None
    assert q.text_query(["body"]) is None
    assert q.bool_() is None
    assert q.bool_(must=[None], should=None, minimum_should_match=1) is None
    assert q.boosting() is None
    assert q.filtered(None, None) is None
    assert q.template(None, {"a": 1}) is None
    assert q.bucket("none") is None


def test_filtered_keeps_the_only_side():
    query = q.term("tag", "a")
    assert q.filtered(query, None) is query


def test_template_without_parameters():
    assert q.template(lambda: q.match_all()) is not None


def test_term_and_terms(docs):
    assert ids(docs, q.term("tag", "a")) == [1]
    assert ids(docs, q.term("labels", "y")) == [1, 2]
    assert ids(docs, q.terms("tag", ["a", "ab"])) == [1, 4]
    assert ids(docs, q.terms("labels", ["x", "z"])) == [1]
    assert ids(docs, q.terms("tag", [])) == []
    assert ids(docs, q.terms("labels", [])) == []


def test_range_with_one_op_twice_takes_the_second(docs):
    assert ids(docs, q.range_("n", ("gt", 5), ("gt", 15))) == [2, 3]
    assert ids(docs, q.range_("n", ("lte", 20))) == [1, 2]
    with pytest.raises(ValueError):
        q.range_("n", ("above", 1))


def test_missing_values_never_match_and_survive_negation(docs):
    assert ids(docs, q.bool_(must_not=q.term("tag", "a"))) == [2, 3, 4]
    assert ids(docs, q.bool_(must_not=q.match("body", "red"))) == [3, 4]
    assert ids(docs, q.bool_(must_not=q.bool_(should=[q.term("tag", "b"), q.range_("n", ("gte", 30))]))) == [1, 4]


def test_bool_minimum(docs):
    should = [q.term("tag", "a"), q.range_("n", ("lt", 25)), q.term("labels", "y")]
    assert ids(docs, q.bool_(should=should)) == [1, 2]
    assert ids(docs, q.bool_(should=should, minimum_should_match=3)) == [1]
    assert ids(docs, q.bool_(must=q.match_all(), should=should)) == [1, 2, 3, 4]
    assert ids(docs, q.bool_(must=q.match_all(), minimum_should_match=1)) == []
    assert required_matches("67%", 3) == 2
    assert required_matches("66%", 3) == 1


def test_or_filter_of_nothing_matches_nothing(docs):
    assert ids(docs, q.or_filter([])) == []
    assert ids(docs, q.or_filter([None, q.term("tag", "b")])) == [2]


def test_multi_match_of_empty_text_matches_nothing(docs):
    assert ids(docs, q.multi_match(["body", "tag"], "")) == []
    assert ids(docs, q.match("body", "?!")) == []


def test_match_kinds(docs):
    assert ids(docs, q.match("body", "RED fox")) == [1, 2]
    assert ids(docs, q.match("body", "fox")) == [1]
    assert ids(docs, q.match("body", "fox's")) == [4]
    assert ids(docs, q.match("body", "red fox", operator="and")) == [1]
    assert ids(docs, q.match("body", "red fox", type="phrase")) == [1]
    assert ids(docs, q.match("body", "red f", type="phrase_prefix")) == [1]
    assert ids(docs, q.phrase_prefix("body", "re")) == [1, 2]
    with pytest.raises(ValueError):
        q.match("body", "x", operator="xor")


def test_names_lose_their_suffix_and_cover_sub_clauses(docs):
    query = q.bool_(should=[q.term("tag", "a", name="tagged##7"), q.range_("n", ("gt", 0), name="counted")], name="any")
    hits = q.search(docs, query=query, size=None, fields=["_id"]).hits
    assert {r["_id"]: r["matched_queries"] for r in hits.collect()} == {
        1: ["any", "tagged", "counted"],
        2: ["any", "counted"],
        3: ["any", "counted"],
    }


def test_lookup_paths_may_be_arrays(spark, docs):
    lookup = spark.createDataFrame([("k", ["a", "b", None])], "id string, wanted array<string>")
    assert ids(docs, q.terms_lookup("tag", lookup.where("id = 'k'"), "wanted")) == [1, 2]
    assert ids(docs, q.bool_(must_not=q.terms_lookup("tag", lookup, "wanted"))) == [3, 4]
    assert ids(docs, q.terms_lookup("tag", lookup.where("id = 'other'"), "wanted")) == []


def test_scores_of_plain_clauses(docs):
    query = q.bool_(must=q.match_all(), should=[q.term("tag", "a"), q.term("labels", "y")])
    hits = q.search(docs, query=query, fields=["_id"]).hits.collect()
    assert [(r["_id"], r["score"]) for r in hits] == [(1, 3.0), (2, 2.0), (3, 1.0), (4, 1.0)]
    only_not = q.search(docs, query=q.bool_(must_not=q.term("tag", "a")), size=None).hits
    assert {r["score"] for r in only_not.collect()} == {1.0}


def test_sorted_search_has_no_scores(docs):
    result = q.search(docs, query=q.match("body", "red"), sort=[("n", "desc")], fields=["_id"])
    assert [(r["_id"], r["score"]) for r in result.hits.collect()] == [(2, None), (1, None)]
    assert result.summary.first().asDict() == {"total": 2, "max_score": None}


def test_boosting_sides(docs):
    only_negative = q.search(docs, query=q.boosting(negative=q.term("tag", "a")), size=None, fields=["_id"]).hits
    assert {r["_id"]: r["score"] for r in only_negative.collect()} == {1: 0.2, 2: 1.0, 3: 1.0, 4: 1.0}
    only_positive = q.search(docs, query=q.boosting(q.term("tag", "a")), size=None, fields=["_id"]).hits
    assert {r["_id"]: r["score"] for r in only_positive.collect()} == {1: 1.0}


def test_function_score_without_query_or_functions(docs):
    hits = q.search(docs, query=q.function_score(None, [], "sum"), size=None, fields=["_id"]).hits
    assert {r["score"] for r in hits.collect()} == {1.0}
    with pytest.raises(ValueError):
        q.function_score(None, [], "median")


def test_stored_tokens_give_the_same_hits(docs):
    from quillspan.functions import text as ta

    stored = docs.withColumn("words", ta.tokens(F.col("body")))
    for clause in (
        q.match("body", "red fox"),
        q.match("body", "red fox", operator="and"),
        q.phrase("body", "red fox"),
        q.phrase_prefix("body", "the fox'"),
        q.match("body", "red fox", minimum_should_match=2),
    ):
        plain = q.search(docs, query=clause, size=None, fields=["_id"]).hits
        using = q.search(stored, query=clause, size=None, fields=["_id"], token_columns={"body": "words"}).hits
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, using.collect()))
