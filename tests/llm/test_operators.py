"""Each operator against brute force, and on nulls, empty and long texts, repeated rows, empty tables and odd columns."""

import collections
import hashlib
import math
import re
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillspan.llm import html_text, language, licenses, lmscore, mixing, neardup, quality, substrings, tokens
from quillspan.llm.components import components
from quillspan.llm.decontaminate import decontaminate
from quillspan.llm.queries import ORACLES, QUERIES
from tests.oracle_compare import compare, open_tables

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({c: c + 32 for c in range(65, 91)})


def prose(n, salt=0):
    return " ".join(f"w{(i * 7919 + salt * 104729) % 100003}" for i in range(n))


SHARED = prose(60, 9)
ODD = [
    (1, None, None, "a"),
    (2, "", "en", None),
    (3, " \t\n ", "en", "a"),
    (4, "one two", "en", "a"),
    (5, "one two", "en", "a"),
    (5, "one two", "en", "a"),
    (None, "an id that is null", None, None),
    (6, prose(6000, 1), "en", "b"),
    (7, prose(80, 2) + " " + SHARED + " " + prose(40, 3), "en", "b"),
    (8, prose(50, 4) + "\n" + SHARED, "fr", "b"),
    (9, "la la " * 200, "fr", "b"),
    (10, prose(300, 5), "fr", "b"),
    (11, prose(300, 5) + " end", "fr", "b"),
    (12, "Ünïcödé 日本語 \x00 🙂 <|endoftext|> ½", "xx", "c"),
]
CLASH = ["_id", "_row", "_text", "_key", "text_id", "node", "n", "word", "k_doc_id", "rules", "kept", "stratum", "label", "path", "own"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string")
    return rows.withColumn("n_chars", F.length("text").cast("long")).select("*", *(F.lit(c).alias(c) for c in CLASH)).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql_twin(spark, name):
    problem, _, rows = compare(spark, open_tables(SMALL), name, QUERIES[name], ORACLES[name], SMALL)
    assert problem is None and rows


def brute_removed(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    count = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_substrings_of_odd_texts(odd, none):
    rows = substrings.remove_repeats(odd, keep=["doc_id", "node"]).collect()
    assert sorted((r["n_words"], r["n_removed"], r["kept_text"]) for r in rows) == sorted(brute_removed([t[1] for t in ODD], 35))
    assert {r["node"] for r in rows} == {"node"}
    assert substrings.remove_repeats(none).count() == 0


def test_substrings_where_paths_branch(spark):
    words = [f"x{i}" for i in range(200)]
    texts = [" ".join(words), " ".join(words[:90] + ["?"] + words[91:]), " ".join(words[40:80] * 2), "a " * 100, "b a a a"]
    texts += [" ".join(words[i : i + 35]) for i in (0, 17, 165)] + [" ".join(words[i : i + 34]) for i in (3, 120)]
    rows = substrings.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_removed"], r["kept_text"]) for r in rows] == brute_removed(texts, 35)


def test_decontamination_of_odd_texts(spark, odd, none):
    long_item = " ".join(SHARED.split()[5:30])
    items = [(1, long_item.upper()), (1, "one, two!"), (2, None), (None, "日本語"), (3, "..."), (4, prose(20, 77))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("x"))
    found = decontaminate(odd, bench)
    by = by_id(found)
    assert by[4]["items"] == ["1"] and by[4]["n_hit"] == 2 and by[5]["contaminated"]
    assert by[7]["n_hit"] == by[8]["n_hit"] == 25 and by[7]["spans"][0]["start"] == 85
    assert by[12]["items"] == [""] and by[12]["n_hit"] == 1
    assert by[1]["n_words"] == 0 and not by[10]["contaminated"] and found.count() == len(ODD)
    assert decontaminate(none, bench).count() == 0
    assert decontaminate(odd, bench.limit(0)).where("contaminated").count() == 0


def test_near_duplicates_of_odd_texts(odd, none):
    found = neardup.near_duplicates(odd)
    by = by_id(found)
    assert by[4]["class_id"] == by[5]["class_id"] == 4
    assert by[10]["class_id"] == by[11]["class_id"] == 10 and by[10]["n_texts"] == 2
    assert by[1]["class_id"] == 1 and by[2]["kept"] and by[3]["kept"]
    assert found.where("kept").count() == len(ODD) - 3 and found.count() == len(ODD)
    assert neardup.near_duplicates(none).count() == 0


def test_near_duplicate_classes_equal_brute_force(spark):
    docs = [(r["doc_id"], WORD.findall(r["text"])) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    edited = []
    for i, words in docs[:60]:  # chains of copies, each a little further from the first
        for step in range(1, 4):
            at = len(words) // 2
            words = words[:at] + [f"edit{i}.{step}"] + words[at + 1 :]
            edited.append((100_000 + 10 * i + step, words))
    docs += edited
    sets = [collections.Counter(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else collections.Counter([tuple(w)]) for _, w in docs]
    df = collections.Counter(x for s in sets for x in s)
    share = neardup.IDF_SHARE
    weight = {x: 1 + share * math.log((len(docs) + 1) / (n + 1)) for x, n in df.items()}
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    near = 0
    for a in range(len(docs)):
        for b in range(a):
            both = sum(min(n, sets[b][x]) * weight[x] for x, n in sets[a].items())
            total = sum(n * weight[x] for s in (sets[a], sets[b]) for x, n in s.items())
            similarity = both / (total - both)
            near += abs(similarity - 0.8) < 1e-3  # there hashed and true frequencies may disagree
            if similarity >= 0.8:
                parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(rows).collect()}
    wrong = sum(got[doc_id] != least[root(i)] for i, (doc_id, _) in enumerate(docs))
    assert wrong <= 4 * near


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_token_counts_equal_the_library(spark, odd, none):
    public = pytest.importorskip("public_tokenizers")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(public.path("word_bpe_49k.json"))
    path = public.path("word_bpe_49k.json")
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(60).collect()]
    texts += [t[1] for t in ODD] + ["aaaa" * 40, "it's WE'LL <|startoftext|><|endoftext|>", "ΣΑΣ\x1c\x85É é"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(tokens.count_tokens(rows, path, keep=["doc_id"]))
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((text or "").encode()), n > 2048)
    assert tokens.count_tokens(odd, path, keep=["doc_id", "word"]).count() == len(ODD)
    assert tokens.count_tokens(none, path, keep=["doc_id"]).count() == 0


def test_language_scores_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = [r for r in QUERIES["op8_language"](spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert len(rows) > 100 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.97 * len(rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)


def test_language_rejects_foreign_and_random_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs.where(language.bucket_of(F.col("doc_id"), 5) != 0))
    rng = np.random.default_rng(1)
    random = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(n))
    polish = (
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować "
        "wobec innych w duchu braterstwa."
    )
    italian = (
        "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso "
        "gli altri in spirito di fratellanza."
    )
    texts = [random(10), random(30), random(300), polish, italian]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["rejected"] for r in language.identify(rows, model, keep=["doc_id"]).orderBy("doc_id").collect()] == [True] * len(texts)
    held = language.identify(docs.where(language.bucket_of(F.col("doc_id"), 5) == 0), model, keep=["doc_id"])
    assert held.where("rejected").count() <= 0.01 * held.count()


def test_language_limits_withstand_outliers_and_few_texts():
    rng = np.random.default_rng(2)
    n = rng.integers(300, 900, 2000)
    lang, above = np.arange(2000) % 2, np.abs(rng.normal(0, 0.1, 2000))
    clean = language._limits(lang, n, above, 3)
    spoilt = language._limits(lang, n, np.where(np.arange(2000) == 7, 50.0, above), 3)
    assert np.isfinite(clean).all() and (spoilt < 2 * clean).all()
    assert np.isfinite(language._limits(lang[:5], n[:5], above[:5], 3)).all()


def test_language_of_odd_texts(spark, odd, none):
    model = language.train(odd, lang_col="lang")
    by = by_id(language.identify(odd, model, keep=["doc_id", "kept"]))
    assert by[1]["lang_pred"] == by[2]["lang_pred"] == "und" and by[1]["score"] == 0 and by[2]["rejected"]
    assert by[4]["lang_pred"] in ("en", "fr", "xx")
    untaught = language.train(none)
    assert {r["lang_pred"] for r in language.identify(odd, untaught, keep=["doc_id"]).collect()} == {"und"}
    assert language.identify(none, model, keep=["doc_id"]).count() == 0


def test_language_model_is_a_distribution(spark):
    texts = ["abab abba", "baba ab", "aab bba b"] * 5
    model = language.train(spark.createDataFrame([(t, "z") for t in texts], "text string, lang string"), order=3, sample=1000)
    letters = np.array([97, 98, 32], np.uint32)
    for history in ((97, 98), (32, 97), (120, 121)):
        p = np.exp(model.log_probability(np.array([[*history, c] for c in letters], np.uint32)))[:, 0]
        others = 1 - len(letters) * model.floor[0]  # order 0 spreads the rest over unseen characters
        rest = np.exp(model.log_probability(np.array([[*history, 999]], np.uint32)))[0, 0] / model.floor[0] * others
        assert p.sum() + rest == pytest.approx(1, abs=1e-9)


def test_lm_base_scores_and_gain(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    words = {r["doc_id"]: WORD.findall((r["text"] or "").translate(FOLD)) + ["\x00"] for r in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    counts = collections.Counter(w for i, x in words.items() if not held[i] for w in x)
    total, distinct = sum(counts.values()), len(counts)
    rows = by_id(QUERIES["op1_lm_scores"](spark, SMALL))
    for i, x in words.items():
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in x)
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(x), sum(counts[w] > 0 for w in x), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    assert sum(r["score"] for i, r in rows.items() if held[i]) > sum(r["base_score"] for i, r in rows.items() if held[i])


def test_lm_automaton_equals_direct_interpolation(spark):
    texts = ["a b c a b d", "a b c", "b c a a", "c d"] * 3
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    query = [(100, "a b c a b zz c d"), (101, ""), (102, None), (103, " ".join(["a b c"] * 300))]
    got = by_id(lmscore.score(spark.createDataFrame(query, "doc_id long, text string"), rows, keep=["doc_id"]))
    streams = [WORD.findall(t) + ["\x00"] for t in texts]
    c = [collections.Counter(tuple(s[i : i + n]) for s in streams for i in range(len(s) - n + 1)) for n in (1, 2, 3)]

    def discount(counts):
        one, two = (sum(v == k for v in counts.values()) for k in (1, 2))
        return min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.5

    d = [discount(x) for x in c]
    total = sum(c[0].values())

    def p(history, w):
        if not history:
            n = c[0][(w,)]
            return (n - d[0]) / total if n else d[0] * len(c[0]) / total
        if history[-1:] == ("zz",):
            return p((), w)
        n = len(history)
        seen = c[n - 1][history] if all((x,) in c[0] for x in history) else 0
        kept = {k: v for k, v in c[n].items() if k[:-1] == history and v > 1}
        if not seen or (n == 2 and seen < 2):
            return p(history[1:], w)
        left = 1 - sum(v - d[n] for v in kept.values()) / seen
        return max(0, kept.get((*history, w), d[n]) - d[n]) / seen + left * p(history[1:], w)

    for i, text in query:
        s = WORD.findall(text or "") + ["\x00"]
        expected = sum(math.log10(p(tuple(s[max(0, j - 2) : j]), w)) for j, w in enumerate(s))
        assert got[i]["score"] == pytest.approx(expected, rel=1e-6)


def test_lm_counts_grams_of_all_words(spark, monkeypatch):
    common = [" ".join(f"c{i}" for i in range(17000))] * 3  # more words, and more frequent ones, than the cap once left
    texts = common + ["rare pair of words", "a rare pair of words", "one rare pair"]
    query = [(1, "rare pair of words"), (2, "a rare pair c5 c6 c7 of unheard words"), (3, None), (4, "pair pair rare"), (4, "pair pair rare")]
    streams = [WORD.findall(t) + ["\x00"] for t in texts]
    c = [collections.Counter(tuple(s[i : i + n]) for s in streams for i in range(len(s) - n + 1)) for n in (1, 2, 3)]
    once, twice = ([sum(v == k for v in x.values()) for x in c] for k in (1, 2))
    d = [min(0.95, max(0.1, a / (a + 2 * b))) if a else 0.5 for a, b in zip(once, twice)]
    total, taken = sum(c[0].values()), collections.Counter()
    for n in (1, 2):
        for k, v in c[n].items():
            if v > 1:
                taken[k[:-1]] += v - d[n]

    def p(history, w):
        n = len(history)
        if not n:
            return (c[0][(w,)] - d[0]) / total if c[0][(w,)] else d[0] * len(c[0]) / total
        if c[n - 1][history] < n:  # contexts of two words are states if they occur twice
            return p(history[1:], w)
        v = c[n][(*history, w)]
        return (v - d[n] if v > 1 else 0) / c[n - 1][history] + (1 - taken[history] / c[n - 1][history]) * p(history[1:], w)

    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    asked = spark.createDataFrame(query, "doc_id long, text string")
    for head, gram_head, join in ((1 << 18, 1 << 17, "10m"), (17000, 17000, "-1"), (1, 1, "-1")):
        monkeypatch.setattr(lmscore, "HEAD", head)
        monkeypatch.setattr(lmscore, "GRAM_HEAD", gram_head, raising=False)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", join)
        try:
            got = lmscore.score(asked, rows, keep=["doc_id"]).collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert len(got) == len(query)
        for i, text in query:
            s = WORD.findall(text or "") + ["\x00"]
            expected = sum(math.log10(p(tuple(s[max(0, j - 2) : j]), w)) for j, w in enumerate(s))
            for r in got:
                if r["doc_id"] == i:
                    assert r["score"] == pytest.approx(expected, rel=1e-9) and r["n_known"] == sum(c[0][(w,)] > 0 for w in s)


def test_lm_of_odd_texts(odd, none):
    assert lmscore.score(odd, odd, keep=["doc_id", "word"]).count() == len(ODD)
    untaught = lmscore.score(odd, none, keep=["doc_id"]).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == 0 for r in untaught)
    assert lmscore.score(none, odd, keep=["doc_id"]).count() == 0


PAGE = """<html><body><div id="top"><a href=1>Home</a> <a href=2>About us</a></div><div class="cookie-notice">We use cookies.
</div><div class="content"><h2>Title</h2><p>First paragraph of the story with a lot of words in it &amp; more.</p><p>Short.</p>
<div class="ad">Buy now</div><p>Second <b>para</b>graph with <a href=x>a link</a> and many&nbsp;more words.</p></div>
<div id="comments"><p>I liked this story very much, thank you for all the words.</p></div><script>x="<p>no</p>"</script></body></html>"""


def test_page_text():
    assert html_text.main_text(PAGE) == (
        "Title First paragraph of the story with a lot of words in it & more. Short. Second paragraph with a link and many more words."
    )
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("<article><p>Cut off in a ta<di") == "Cut off in a ta"
    assert html_text.main_text("<div>" * 3000 + "deep") == "deep"


def test_page_text_keeps_the_whole_article():
    words = lambda n, x: " ".join([x] * n)
    a, b, lead = words(500, "abc"), words(75, "def"), words(25, "ghi")
    parts = f"<h1>T</h1><p>{lead}</p><section><p>{a}</p></section><section><p>{b}</p></section>"
    whole = f"T {lead} {a} {b}"
    menu = "<ul><li><a href=1>Home</a></li><li><a href=2>About</a></li></ul>"
    for page in (f"<body>{menu}<article>{parts}</article></body>", f"<body>{menu}<main><div>{parts}</div></main></body>", f"<body>{menu}<div><div>{parts}</div></div></body>"):
        assert html_text.main_text(page) == whole
    for name in ("content layout-sidebar-right", "post-header"):
        assert html_text.main_text(f"<body>{menu}<div class='{name}'>{parts}</div></body>") == whole
        assert html_text.main_text(f"<body>{menu}<div class='{name}'>{parts}") == whole
        assert html_text.main_text(f"<body><article>{parts}</article><div class='{name}'><p>{words(900, 'xyz')}</p></div></body>") == whole


def test_page_text_of_the_table(spark):
    import html as h

    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    rows = {r["page_id"]: r for r in QUERIES["op6_html_text"](spark, SMALL).collect()}
    for r in pages:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        text = " ".join(h.unescape(re.sub(r"<[^>]*(>|\Z)", " ", inner.replace("<b>", "").replace("</b>", ""))).split())
        assert (rows[r["page_id"]]["text"], rows[r["page_id"]]["n_chars"]) == (text, len(text))


def test_quality_base_and_bound(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = by_id(QUERIES["op7_quality"](spark, "/root/testdata/sf0.01"))
    for r in docs.collect():
        w, lines = WORD.findall(r["text"] or ""), [x for x in (r["text"] or "").split("\n") if WORD.search(x)]
        grams = collections.Counter(zip(w, w[1:], w[2:]))
        inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
        got = rows[r["doc_id"]]
        assert got["n_words"] == len(w) and got["word_chars"] == sum(map(len, w)) and got["n_repeat_words"] == len(inside)
        assert got["n_symbols"] == len(re.findall(r"[#*$%&|<>]", r["text"] or "")) and got["n_dup_lines"] == len(lines) - len(set(lines))
        assert got["base_failed"] == (len(w) < 50 or 100 * len(inside) > 50 * len(w))
        assert not (got["kept"] and got["base_failed"])
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (6, None)], "doc_id long, quality int")
    found = quality.assess(odd, labels, stratum=odd["lang"])
    assert found.count() == len(ODD) and by_id(found)[6]["kept"] and not by_id(found)[1]["kept"]
    assert quality.assess(none, labels, stratum=none["lang"]).count() == 0


def test_quality_cut_offs_obey_the_exact_bound(spark):
    n, risk, delta = 4000, 0.05, 0.05
    rows = [("s", 100 + i, 500, 0, 10, 0, i % 100) for i in range(n)]
    held = spark.createDataFrame(rows, "stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")
    got = {r["rule"]: r["cutoff"] for r in quality._cut_offs(held, risk, delta).collect()}
    tests, p = sum(len(g) for _, g in quality.RULES.values()), risk / len(quality.RULES)

    def tail(k):
        return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))

    for name, measure in (("repeats", lambda r: r[6] / r[1]), ("symbols", lambda r: 0.0), ("long_words", lambda r: r[2] / r[1])):
        fit = [c for c in quality.RULES[name][1] if tail(sum(measure(r) > c for r in rows)) <= delta / tests]
        assert got.get(name) == (min(fit) if fit else None)


def test_mixing_meets_targets_and_budget(spark, odd, none):
    rows = spark.range(4000).selectExpr("id AS doc_id", "concat('a ', repeat('b ', int(id % 7))) AS text", "if(id % 3 = 0, 'x', 'y') AS source")
    share = spark.createDataFrame([("x", 0.5), ("y", 0.5)], "value string, share double")
    mixed = mixing.mix(rows, {"source": rows["source"]}, targets={"source": share}, budget_share=0.5).cache()
    sums = {r[0]: r[1] for r in mixed.groupBy("in_source").agg(F.sum(F.col("n_tokens") * F.col("probability"))).collect()}
    assert sums["x"] == pytest.approx(sums["y"], rel=1e-9)
    total = mixed.agg(F.sum("n_tokens")).first()[0]
    assert sum(sums.values()) == pytest.approx(0.5 * total, rel=1e-9)
    taken = mixed.where("sampled").agg(F.sum("n_tokens")).first()[0]
    assert taken == pytest.approx(0.5 * total, rel=0.05)
    found = mixing.mix(odd, {"source": odd["source"], "topic": mixing.topic(odd["text"])}, budget_share=1.0, keep=["doc_id", "n"])
    assert found.count() == len(ODD) and found.where("in_source = '(none)'").count() == 2
    assert mixing.mix(none, {"source": none["source"]}).count() == 0


def test_mixing_holds_margins_though_cells_are_full(spark):
    # Sources x (a third of the rows) and z have too little for their shares in some cells, so cells fill up.
    rows = spark.range(6000).selectExpr(
        "id AS doc_id", "concat('a ', repeat('b ', int(id % 5))) AS text", "CASE WHEN id % 3 = 0 THEN 'x' WHEN id % 50 = 1 THEN 'z' ELSE 'y' END AS source",
        "CASE WHEN id % 20 < 3 THEN 'de' WHEN id % 7 = 0 THEN NULL ELSE 'en' END AS lang", "id % 2 AS tokens",
    )
    dims = {"source": rows["source"], "lang": rows["lang"]}
    share = spark.createDataFrame([("x", 3.0), ("y", 5.0), ("z", 2.0), ("unseen", 9.0)], "value string, share double")
    cells = mixing.calibrate(rows, dims, targets={"source": share}, budget_share=0.6)
    found = {(r["dimension"], r["value"]): r for r in mixing.margins(cells, ["in_source", "in_lang"]).collect()}
    budget = 0.6 * sum(r["tokens"] for k, r in found.items() if k[0] == "in_source")
    for r in found.values():
        assert r["expected"] == pytest.approx(r["target"], abs=1e-8 * budget) and r["target"] <= r["tokens"] + 1e-9
    z = found["in_source", "z"]
    assert z["expected"] == pytest.approx(z["tokens"])  # all of it is less than its share
    rest = budget - z["tokens"]
    assert found["in_source", "x"]["expected"] == pytest.approx(3 / 8 * rest) and found["in_source", "y"]["expected"] == pytest.approx(5 / 8 * rest)
    # One dimension against brute force: the factor at which min(tokens, factor * share) meets the budget.
    alone = mixing.calibrate(rows, {"source": rows["source"]}, targets={"source": share.where("value <> 'y'")}, budget_share=0.2)
    got = {r["in_source"]: r["probability"] for r in alone.collect()}
    assert got["y"] == 0 and got["z"] == pytest.approx(1) and 0 < got["x"] < 1
    # Targets that contradict each other end after the given rounds, with probabilities from 0 to 1.
    at_odds = mixing.calibrate(rows, {"source": rows["source"], "lang": rows["source"]}, targets={"source": share}, budget_share=0.6, rounds=4)
    assert at_odds.where("probability < 0 or probability > 1 or probability is null").isEmpty()


def test_licences_and_inheritance(spark, odd, none):
    files = [
        ("a/LICENSE", "\nReleased under the MIT License.\n"),
        ("a/b/c.py", "x = 1"),
        ("a/b/d.py", "# Licensed under the Apache License, Version 2.0.\ny = 2"),
        ("a/b/e/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/e/f/g.py", None),
        ("h.py", "no notice"),
        (None, ""),
    ]
    rows = spark.createDataFrame(files, "path string, text string").withColumn("own", F.lit(1))
    got = {r["path"]: (r["own"], r["licence"], r["licence_from"]) for r in licenses.scan_licences(rows, path=rows["path"], keep=[]).collect()}
    assert got["a/b/c.py"] == (None, "MIT", "a") and got["a/b/d.py"][0] == "Apache-2.0"
    assert got["a/b/e/f/g.py"] == (None, "GPL-3.0", "a/b/e") and got["h.py"] == (None, None, None) and got[""] == (None, None, None)
    assert licenses.scan_licences(odd, path=odd["source"], keep=["doc_id"]).count() == len(ODD)
    assert licenses.scan_licences(none, path=none["source"], keep=["doc_id"]).count() == 0


def test_licences_by_identifier_and_not_where_negated(spark):
    texts = {
        "// SPDX-License-Identifier: MIT\nint x;": "MIT",
        "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0",
        "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "SPDX-License-Identifier: Unheard-1.0": None,
        "This is not released under the MIT License.": None,
        "It is no longer released under the MIT License": None,
        "The code isn't yet released under the MIT License.": None,
        "This work is not licensed under the GNU General Public License, version 3.": None,
        "This does not matter here. Released under the MIT License.": "MIT",
        "Some rights reserved by us, all rights of others are reserved": None,
        "Copyright 2020 A. Body. All rights reserved.": "Proprietary",
        "license " * 3000: None,
        "licence rights " * 500 + "Released under the MIT License. " * 200: "MIT",
    }
    rows = spark.createDataFrame([(f"d{i}/f", t) for i, t in enumerate(texts)], "path string, text string")
    got = {r["path"]: r["own"] for r in licenses.scan_licences(rows, path=rows["path"], keep=[]).collect()}
    assert [got[f"d{i}/f"] for i in range(len(texts))] == list(texts.values())


def test_licences_of_wrapped_headers_whole_files_and_long_lines(spark):
    def wrapped(text, mark="# ", width=60):
        return "\n".join(mark + x for x in textwrap.wrap(text, width))

    gpl = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version {} of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will "
        "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General "
        "Public License for more details.\n\nYou should have received a copy of the GNU General Public License along with this program."
    )
    mit, bsd2, bsd3 = licenses.TEMPLATES["MIT"][1], licenses.TEMPLATES["BSD-2-Clause"][0], licenses.TEMPLATES["BSD-3-Clause"][1]
    holder = "Copyright (c) 2020, Some Body. All rights reserved.\n\n"
    code = "\n".join(f"x{i} = f{i}(y{i})" for i in range(300))
    files = {
        "gpl3.py": (wrapped("Tool of ours. Copyright (C) 2020 Some Body") + "\n#\n" + wrapped(gpl.format(3)) + "\n" + code, "GPL-3.0"),
        "gpl2.c": (wrapped(gpl.format(2), " * ", 70) + "\n" + code, "GPL-2.0"),
        "mit/LICENSE": ("MIT License\n\nCopyright (c) 2020 Some Body\n\n" + wrapped(mit, "", 75), "MIT"),
        "grant.js": (wrapped(mit, "// ") + "\n" + code, "MIT"),
        "bsd3/LICENSE": (holder + wrapped(bsd3, "", 75), "BSD-3-Clause"),
        "bsd2/LICENSE": (holder + wrapped(bsd2, "", 75), "BSD-2-Clause"),
        "long.txt": (prose(400, 1) + " Released under the MIT License. " + prose(400, 2), "MIT"),
        "owned.py": ("# Copyright Some Body. All rights reserved.\n" + code, "Proprietary"),
        "none.py": (code + "\n# the licence of the driver and its copyright are not known", None),
    }
    rows = spark.createDataFrame([(k, v[0]) for k, v in files.items()], "path string, text string")
    got = {r["path"]: r["own"] for r in licenses.scan_licences(rows, path=rows["path"], keep=[]).collect()}
    assert got == {k: v[1] for k, v in files.items()}


def test_licence_query_searches_ancestors(spark):
    rows = QUERIES["op2_licences"](spark, "/root/testdata/sf0.01").where("own is null and licence is not null").collect()
    assert any(r["licence_from"] != r["path"].rpartition("/")[0] for r in rows)


def test_pipeline_stages(spark, tmp_path):
    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, ids = source.columns, source.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "substrings", "decontamination", "mixing"]
    docs = source
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        assert docs.columns[: len(columns)] == columns
        assert docs.count() <= before.count()
        if name == "near_duplicates":
            assert docs.select(F.md5("text")).distinct().count() == docs.count()
        if name == "substrings":
            assert docs.count() == before.count()
            kept = {r["doc_id"]: r["text"] for r in docs.collect()}
            given = [r["text"] for r in before.orderBy("doc_id").collect()]
            expected = brute_removed(given, 35)
            assert [" ".join(WORD.findall(kept[k])) for k in sorted(kept)] == [x[2] for x in expected]
            clean = [(kept[k], t) for k, t, x in zip(sorted(kept), given, expected) if not x[1]]
            assert clean and all(a == b for a, b in clean)
    assert 0 < docs.count() < ids


def test_hash_of_kept_words(spark):
    row = QUERIES["op4_substrings"](spark, SMALL).where("n_words = 0 OR n_removed = n_words").first()
    assert row is None or row["kept_sha256"] == hashlib.sha256(b"").hexdigest()
