"""Every stage of the pipeline on odd rows, empty tables and columns of all names that the stages use themselves."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillspan.llm import language
from tests.llm.test_operators import ODD, prose

SMALL = "/root/testdata/sf0.001"
NAMES = (
    "score rejected lang_pred cross_entropy _id _md5 _digest kept text_md5 class_id kept_text n_words n_removed n_tokens topic probability "
    "sampled in_topic in_source _text _row _key k_doc_id _others spans found items contaminated extra_0 weight ratio scale tokens"
).split()
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    """Documents of one language with odd rows among them, and a column of each name whose value names its row."""
    plain = [(100 + i, "the quick brown fox jumps over the lazy dog number " + prose(30, i), "en", "s") for i in range(12)]
    rows = spark.createDataFrame([*ODD, *plain], "doc_id bigint, text string, lang string, source string")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("seen", F.monotonically_increasing_id())
    own = F.concat_ws("|", F.lit("own"), F.col("doc_id").cast("string"), F.md5("text"))
    return rows.select("*", *(own.alias(n) for n in NAMES)).withColumn("Text2", F.lit(1)).repartition(3).cache()


@pytest.mark.parametrize("name", list(STAGES))
def test_other_columns_survive(spark, docs, name):
    done = STAGES[name](spark, docs, SMALL).cache()
    assert done.columns[: len(docs.columns)] == docs.columns
    added = done.columns[len(docs.columns) :]
    assert added == (["mixing_n_tokens", "mixing_topic", "mixing_probability"] if name == "mixing" else [])
    # Each row still carries the values it came with, in all columns.
    given = {r["seen"]: r for r in docs.collect()}
    for r in done.collect():
        assert [r[n] for n in NAMES] == [given[r["seen"]][n] for n in NAMES]
        assert r["doc_id"] == given[r["seen"]]["doc_id"]
    assert done.count() > 0
    empty = STAGES[name](spark, docs.limit(0), SMALL)
    assert empty.columns == done.columns and empty.count() == 0


def test_one_of_equal_rows_stays_whatever_their_order(spark, docs):
    twins = spark.createDataFrame([(1, "a b c", "en", "s", 5, x) for x in "cabd"], "doc_id bigint, text string, lang string, source string, n_chars bigint, tag string")
    for order in ("tag", "tag desc"):
        rows = twins.repartitionByRange(2, F.expr(order.split()[0]))
        assert [r["tag"] for r in STAGES["near_duplicates"](spark, rows, SMALL).collect()] == ["a"]


def test_clean_texts_are_byte_equal_and_only_spans_go(spark):
    span = prose(40, 9)
    texts = ["  a\n\n b\tc  ", "", "x  y　z\n" + prose(50, 2).replace(" ", "\n  "), f"head \n {span}  tail\n\nend ", f"{span}\n", None, f"\t{prose(7, 3)}  {span}"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    done = STAGES["substrings"](spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), SMALL)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in done.collect()}
    want = [re.sub(re.escape(span) + r"(\s+(?=\S))?", "", t) if t else "" for t in texts]
    assert [got[i][0] for i in range(len(texts))] == want
    assert [got[i][1] for i in range(len(texts))] == [len(t) for t in want]


def test_marks_are_no_letters():
    _, _, _, letters = language._stream(language.np.frombuffer("́̂ 12a".encode(), language.np.uint8), language.np.array([0, 6, 7]), 3)
    assert letters.tolist() == [0, 0]
    _, _, _, letters = language._stream(language.np.frombuffer("́a".encode(), language.np.uint8), language.np.array([0, 3]), 3)
    assert letters.tolist() == [1]
