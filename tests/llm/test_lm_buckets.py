"""The language model's packed shuffles, and shuffle files of what is materialized."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspan.llm import lmscore
from quillspan.plans.durable import materialize


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}


def test_materialize_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = materialize(spark.range(100000).repartition(4, "id").groupBy((F.col("id") % 1000).alias("k")).count())
    assert _shuffle_files(spark) <= before
    assert rows.count() == 1000


def test_packed_numbers_and_lookups_come_back():
    numbers = np.random.default_rng(5).integers(-(1 << 63), (1 << 63) - 1, (3, 1000))
    assert (lmscore._unpacked(1000, 3, lmscore._packed(list(numbers))) == numbers).all()
    hashes = np.unique(numbers).view(np.uint64)
    look = lmscore.Lookup(hashes[::2])
    assert (look.find(hashes) == np.where(np.arange(len(hashes)) % 2 == 0, np.arange(len(hashes)) // 2, -1)).all()
    assert (lmscore.Lookup(hashes[:0]).find(hashes) == -1).all()


def test_dealt_bigrams_take_fewer_bytes_than_rows():
    rng = np.random.default_rng(7)
    v, w = (np.minimum(rng.zipf(1.2, 100000), 1 << 16).astype(np.int64) for _ in range(2))
    dealt = lmscore._dealt_grams(lmscore._pair(v, w), [v, w], len(v), 4)
    assert sum(map(len, dealt.column("data").to_pylist())) < 8 * len(set(zip(v.tolist(), w.tolist())))


def test_lm_scores_do_not_depend_on_buckets_and_runs(spark, monkeypatch):
    words = [f"w{(i * i * 7919) % 211}" for i in range(3000)]
    texts = [" ".join(words[i : i + 40]) for i in range(0, 3000, 20)] + [None, "", "unheard of"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)

    def scores():
        return {r["doc_id"]: r for r in lmscore.score(rows, rows.where("doc_id % 3 > 0"), keep=["doc_id"]).collect()}

    monkeypatch.setattr(lmscore, "HEAD", 20)
    monkeypatch.setattr(lmscore, "GRAM_HEAD", 10)
    whole = scores()
    for name, value in (("SHARE", 50), ("PIECE", 100), ("RUN", 64)):
        monkeypatch.setattr(lmscore, name, value)
    dealt = scores()
    assert len(whole) == len(dealt) == len(texts)
    for i, r in whole.items():
        assert [dealt[i][c] for c in ("n_tokens", "n_known", "train_tokens")] == [r[c] for c in ("n_tokens", "n_known", "train_tokens")]
        assert [dealt[i][c] for c in ("base_score", "score")] == pytest.approx([r["base_score"], r["score"]], rel=1e-9)
