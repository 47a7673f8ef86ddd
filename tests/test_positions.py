"""Positional postings against scans of the texts."""

import random

import pytest
from pyspark.sql import functions as F

import quillspan as q
from quillspan.plans import positions

WORDS = ["the", "of", "thing", "there", "les", "der", "o'clock", "été", "x"]


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choices(WORDS, weights=[9, 7, 3, 2, 2, 1, 1, 1, 1], k=rnd.choice([1, 3, 9, 40, 300]))) for _ in range(200)]
    texts += [None, "", "...", "of the", "OF, the!", "the of the of the", "of of the", "x " * 5000 + "of the"]
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id bigint, t string").withColumn("token", F.lit("a")).repartition(4)


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("positions") / "p")
    positions.write_positions(docs, "id", "t", path, buckets=5, block_chars=2000)
    return positions.read_positions(spark, path)


def rows(df):
    return sorted(map(tuple, df.collect()))


def scan(docs, query, size=None):
    return q.search(docs, "id", query=query, size=size, fields=["id"]).hits


@pytest.mark.parametrize("operator", ["or", "and"])
@pytest.mark.parametrize("text", ["the of LES", "x été absent"])
def test_matches_equal_a_scan(docs, index, text, operator):
    assert rows(positions.match_positions(index, text, operator)) == rows(scan(docs, q.match("t", text, operator=operator)))
    for k in (7,):
        best = [tuple(r) for r in positions.top_positions(index, text, k, operator).collect()]
        assert best == [tuple(r) for r in scan(docs, q.match("t", text, operator=operator), size=k).collect()]


@pytest.mark.parametrize("text", ["of the", "the of the", "o'clock été"])
def test_phrases_equal_a_scan(docs, index, text):
    assert rows(positions.phrase_positions(index, text)) == rows(scan(docs, q.phrase("t", text)))
    assert rows(positions.phrase_positions(index, text, last_is_prefix=True)) == rows(scan(docs, q.phrase_prefix("t", text)))


def test_prefixes_equal_a_scan(docs, index):
    for text in ("th", "of o'", "the zz"):
        assert rows(positions.phrase_positions(index, text, last_is_prefix=True)) == rows(scan(docs, q.phrase_prefix("t", text)))


def test_tokens_meet_without_a_shuffle_and_texts_are_not_read(index, plan):
    for df in (positions.phrase_positions(index, "of the"), positions.phrase_positions(index, "of th", True), positions.match_positions(index, "of the")):
        shown = plan(df)
        assert "Exchange" not in shown and "PushedFilters" in shown
    assert set(index.rows.columns) == {"block", "token", "docs", "df", "cf", "most", "shortest"}
    assert "places" not in plan(positions.match_positions(index, "of the")).split("ReadSchema")[1]


def test_blocks_that_cannot_enter_are_skipped(spark, docs, index):
    with_x = index.rows.where("token = 'x'").select("block").distinct().count()
    for k in (1, 3):
        assert positions.top_blocks(index, "x", k).count() < with_x
    assert positions.top_blocks(index, "x", 10**6).count() == with_x


def test_many_candidate_blocks_are_joined(docs, index, monkeypatch):
    monkeypatch.setattr(positions, "NAMED_BLOCKS", 1)
    best = [tuple(r) for r in positions.top_positions(index, "the of", 50).collect()]
    assert best == [tuple(r) for r in scan(docs, q.match("t", "the of"), size=50).collect()]


def test_postings_of_nothing_and_of_empty_texts(spark, tmp_path):
    for name, data in (("none", []), ("empty", [(1, None), (2, ""), (None, "a b")])):
        df = spark.createDataFrame(data, "id bigint, t string")
        positions.write_positions(df, "id", "t", str(tmp_path / name), buckets=2)
        stored = positions.read_positions(spark, str(tmp_path / name))
        assert rows(positions.match_positions(stored, "a")) == rows(positions.top_positions(stored, "a", 3)) == []
        assert rows(positions.phrase_positions(stored, "a b")) == rows(positions.match_positions(stored, "...")) == []


def test_places_are_delta_coded(index):
    import pyarrow.parquet as pq

    path = index.rows.inputFiles()[0].removeprefix("file:").replace("///", "/")
    group = pq.ParquetFile(path).metadata.row_group(0)
    encodings = {group.column(i).path_in_schema: group.column(i).encodings for i in range(group.num_columns)}
    assert encodings["docs.list.element.places.list.element"] == ("DELTA_BINARY_PACKED",)


def test_buckets_are_dealt_over_tasks(spark, docs, plan, tmp_path, monkeypatch):
    monkeypatch.setattr(positions, "PART_CHARS", 1000)
    path = str(tmp_path / "many")
    positions.write_positions(docs, "id", "t", path, buckets=3, block_chars=500)
    many = positions.read_positions(spark, path)
    files = many.rows.groupBy("_metadata.file_name").agg(F.countDistinct(F.expr("pmod(hash(block), 3)")).alias("buckets")).collect()
    assert len(files) > 6 and {r["buckets"] for r in files} == {1}  # a bucket has several files, a file one bucket
    assert "Exchange" not in plan(positions.phrase_positions(many, "of the"))
    for text in ("of the", "the", "x"):
        assert rows(positions.phrase_positions(many, text)) == rows(scan(docs, q.phrase("t", text)))
        assert rows(positions.match_positions(many, text)) == rows(scan(docs, q.match("t", text)))
