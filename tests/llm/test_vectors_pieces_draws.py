"""Vector codes, pieces and resampling against brute force and the library, on plain and on odd tables."""

import codecs
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspan.llm import codes, pieces, resample
from tests.llm.test_operators import none, odd  # noqa: F401  (fixtures)

SMALL = "/root/testdata/sf0.001"
FOLD = str.maketrans({c: c + 32 for c in range(65, 91)})
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- op12 ---


def brute_codes(rows, k=16, parts=8, rounds=6):
    """``{row number: (code, error, label error)}`` and the digest, for ``rows`` of (id, vector, label) in order of id."""
    x = np.floor(np.array([r[1] for r in rows]) * 4096).astype(np.int64).reshape(len(rows), parts, -1)
    books = x[:k].transpose(1, 0, 2).copy()

    def assign():
        far = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        return far.argmin(2), far.min(2)

    for _ in range(rounds):
        code, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = x[code[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(0) // len(own)
    code, far = assign()
    error, total = far.sum(1), {}
    for r, e in zip(rows, error.tolist()):
        total[r[2]] = total.get(r[2], 0) + e
    found = [("".join(f"{c:02x}" for c in a), e, total[r[2]]) for a, e, r in zip(code, error.tolist(), rows)]
    return found, digest(",".join(map(str, books.ravel().tolist())))


def run_codes(df):
    found, books = codes.compress(df, id_col="vec_id", vector_col="embedding", keep=["vec_id", "label"])
    rows = codes.with_total(found, "label", "error", "label_error").orderBy("vec_id").collect()
    return [(r["vec_id"], r["code"].hex(), r["error"], r["label_error"]) for r in rows], digest(",".join(map(str, books.ravel().tolist())))


@pytest.mark.parametrize("seed, ties", [(1, False), (2, True)])
def test_codes_equal_brute_force(spark, seed, ties):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(700, 16)) * 0.2
    x = np.round(x * 8) / 8 if ties else x  # many equal parts and equal distances
    rows = [(i, v.tolist(), None if i % 5 == 0 else i % 3) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    want, books = brute_codes(rows)
    got, got_books = run_codes(df)
    assert got == [(i, *w) for i, w in enumerate(want)] and got_books == books


def test_codes_query_on_the_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    want, books = brute_codes([(r["vec_id"], r["embedding"], r["label"]) for r in rows])
    got = codes.op12(spark, SMALL).orderBy("vec_id").collect()
    assert [tuple(r) for r in got] == [(r["vec_id"], *w, books) for r, w in zip(rows, want)]


def test_codes_of_odd_vectors(spark):
    good = [(i, [float(i % 4), -0.5] * 4, i % 2) for i in range(20)]
    bad = [(30, None, 1), (31, [], 1), (32, [1.0, None] * 4, 1), (33, [math.nan] * 8, 1), (34, [math.inf] + [0.0] * 7, 1), (35, [0.0] * 7, 1), (36, [0.0] * 16, 1)]
    rows = [*good, good[3], *bad]
    names = ["_id", "_vector", "x", "near", "bounds", "sums", "code", "error", "_by", "_n", "k_label"]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").select("*", *(F.lit(c).alias(c) for c in names))
    kept = sorted([*good, good[3]])
    want, books = brute_codes(kept)
    got, got_books = run_codes(df)
    assert got == [(r[0], *w) for r, w in zip(kept, want)] and got_books == books
    found, _ = codes.compress(df, id_col="vec_id", vector_col="embedding", keep=["vec_id", *names[:6]])
    assert found.columns == ["vec_id", *names[:6], "code", "error"] and found.where("near <> 'near'").isEmpty()
    assert run_codes(df.limit(0))[0] == []
    few, few_books = run_codes(df.where("vec_id < 3 or vec_id is null"))  # fewer vectors than entries
    assert [r[2] for r in few] == [0, 0, 0]
    huge = spark.createDataFrame([(1, [1e30] * 8, 0), (None, [-1e30] * 8, None)], "vec_id bigint, embedding array<double>, label int")
    assert [r[2] for r in run_codes(huge)[0]] == [0, 0]


def test_lists_shrink_and_bounds_hold():
    """Whatever the bounds leave open, the entries are those that all integer distances give."""
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(600, 2, 4)) * 300).astype(np.int64)
    books = codes.Books(x[:16].transpose(1, 0, 2).copy(), np.zeros((2, 16), np.float32), 4)
    state, used = codes._begin(books, x), np.zeros(17, np.int64)
    for turn in range(6):
        near = state.near[:, :, 0].astype(int)
        far = ((x[:, :, None, :] - books.entries[None]) ** 2).sum(3)
        assert (near == far.argmin(2)).all()
        assert (state.bounds[:, :, 0] >= np.sqrt(far.min(2))).all()
        sums = np.zeros((2, 16, 4), np.int64)
        counts = np.zeros((2, 16), np.int64)
        for p in range(2):
            np.add.at(sums[p], near[:, p], x[:, p])
            counts[p] = np.bincount(near[:, p], minlength=16)
        books = codes._next(books, np.concatenate([sums.ravel(), counts.ravel(), used]))
        if turn == 3:
            books.width = 2
        used[:] = 0
        state = codes._follow(books, x, state, used)
    assert state.near.shape[2] - 1 <= 2


# --- op13 ---


@pytest.fixture(scope="module")
def model():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model):
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=model)


def split(values, sizes):
    ends = np.cumsum(sizes).tolist()
    return [values[a:b].tolist() for a, b in zip([0, *ends], ends)]


def test_pieces_equal_the_library(model, library):
    codecs.register_error("by_byte", pieces._by_byte)
    m, rnd = pieces.Model.load(model), random.Random(3)
    letters = "abcdefgh  ▁\t\n=-_.é日本語ん🙂\x00aaaabbeett0123"
    known = [library.id_to_piece(i) for i in range(3, library.get_piece_size())]
    texts = ["", " ", "▁", "a", "<s> </s> <unk> <0x0A>", " " * 5000 + "x", "a" + " " * 3000, "=" * 999, "日本語" * 3000, "ab" * 20000]
    texts += [" " * n + "a" * k for n in range(70) for k in range(3)]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(rnd.choice(known) for _ in range(rnd.randint(1, 12))) for _ in range(6000)]
    ids, sizes = m.of_texts(texts)
    want = library.encode(texts, add_eos=True)
    assert split(ids, sizes) == [w or [library.eos_id()] for w in want]
    assert m.decode(ids, sizes) == [library.decode(w) for w in want]


def test_decoding_of_any_ids_equals_the_library(model, library):
    codecs.register_error("by_byte", pieces._by_byte)
    m, rnd = pieces.Model.load(model), random.Random(4)
    lists = [[rnd.randrange(32000) if rnd.random() < 0.5 else rnd.randrange(262) for _ in range(rnd.randrange(12))] for _ in range(4000)]
    flat = np.array([i for x in lists for i in x], np.int32)
    assert m.decode(flat, np.array([len(x) for x in lists])) == [library.decode(x) for x in lists]
    with pytest.raises(ValueError):
        m.decode(np.array([32000], np.int32), np.array([1]))


def test_words_are_forgotten_without_loss(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    m = pieces.Model.load(model)
    for n in range(6):
        texts = [f"word{n * i} other{i % 3} and more" for i in range(30)]
        assert split(*m.of_texts(texts)) == library.encode(texts, add_eos=True)


def test_pieces_of_odd_texts(spark, odd, none, model, library):  # noqa: F811
    found = pieces.encode(odd.withColumn("ids", F.lit("x")), model, keep=["doc_id", "text", "ids"][:2])
    rows = pieces.decode(found, model, keep=["doc_id", "text", "ids"]).collect()
    assert len(rows) == odd.count()
    for r in rows:
        want = library.encode(r["text"] or "", add_eos=True)
        assert r["ids"] == want and r["decoded"] == library.decode(want)
    assert pieces.encode(none, model, keep=["doc_id"]).collect() == []
    lists = spark.createDataFrame([(1, None), (2, []), (3, [None, 263, None]), (4, [2])], "k bigint, ids array<int>")
    assert [r["decoded"] for r in pieces.decode(lists, model, keep=["k"]).orderBy("k").collect()] == ["", "", library.decode([263]), ""]


def test_pieces_query_on_the_table(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in pieces.op13(spark, SMALL).collect():
        ids = library.encode(texts.pop(r["doc_id"]), add_eos=True)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == digest(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == digest(library.decode(ids))
    assert not texts


# --- op11 ---


def brute_features(text):
    words = ALNUM.findall((text or "").translate(FOLD))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_draw(docs, target, percent=5, least=20):
    """``[(id, features, weight, score, rank)]`` in the order of ``docs``."""
    found = [brute_features(t) for _, t in docs]
    source, other = np.zeros(10000, np.int64), np.zeros(10000, np.int64)
    for _, f in found:
        np.add.at(source, f, 1)
    for t in target:
        np.add.at(other, brute_features(t)[1], 1)
    s, t = int(source.sum()) + 10000, int(other.sum()) + 10000
    gain = [math.floor(1000 * math.log((int(b) + 1) * s / ((int(a) + 1) * t))) for a, b in zip(source, other)]
    out = []
    for (i, _), (_, f) in zip(docs, found):
        h = int(digest(f"42:{'' if i is None else i}")[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r, (n, _) in zip(out, found) if n >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return [tuple(r) for r in out]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_draws_query_equals_brute_force(spark):
    docs, target = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_draw([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert ordered(map(tuple, resample.op11(spark, SMALL).collect())) == ordered(want)
    assert any(r[4] for r in want)


def test_draws_of_odd_texts(spark, odd, none):  # noqa: F811
    extra = ["score", "weight", "rank", "_neg", "_order", "_rank", "n_words"]
    rows = odd.select("*", *(F.lit(c).alias(c) for c in extra if c not in odd.columns))
    docs = [(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()] * 3
    target = spark.createDataFrame([("One TWO la la",), (None,), ("",)], "text string")
    many = rows.unionByName(rows).unionByName(rows)  # every row thrice, so scores and ids tie
    for percent, least in ((50, 1), (100, 0), (0, 0), (5, 20)):
        got = resample.resample(many, target, id_col="doc_id", keep=["doc_id"], percent=percent, least_words=least)
        want = brute_draw(docs, ["One TWO la la", None, ""], percent, least)
        got = [tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in got.collect()]
        assert ordered(got) == ordered(want)
    kept = resample.resample(many, target, id_col="doc_id", keep=["text_id", "node"])
    assert kept.columns == ["text_id", "node", "n_words", "n_features", "weight", "score", "rank"]
    assert resample.resample(none, target.limit(0), id_col="doc_id", keep=["doc_id"]).collect() == []
    by_name = resample.resample(many.withColumn("name", F.col("doc_id").cast("string")), target, id_col="name", keep=["name"], percent=40, least_words=0)
    assert by_name.where("rank is not null").count() == 40 * len(docs) // 100


def test_cut_off_is_the_exact_key(spark):
    rnd = random.Random(6)
    for n, values in ((1, 3), (2000, 4), (3000, 10**6)):
        keys = [(rnd.randrange(values), rnd.randrange(values), i) for i in range(n)]
        df = spark.createDataFrame(keys, "_neg bigint, _order bigint, _row bigint").repartition(6).persist()
        keys.sort()
        for k in {1, n // 20 + 1, n // 2 + 1, n}:
            assert resample.cut_off(df, k) == keys[k - 1]
        assert resample.cut_off(df, n + 1) is None
        df.unpersist()


def test_crc_of_long_words_and_runs():
    texts = ["", "é" * 500 + " short " + "x" * 63 + " " + "y" * 64 + " " + "Z" * 65, "a b c d", "日本 " * 40]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    buckets, rows = resample._features(resample.W.of_bytes(np.frombuffer(data, np.uint8), offsets, resample.W.ALNUM_FOLDED))
    for i, t in enumerate(texts):
        assert sorted(buckets[rows == i].tolist()) == sorted(brute_features(t)[1])
