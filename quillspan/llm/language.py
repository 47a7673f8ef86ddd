"""Language identification by interpolated Kneser-Ney models of characters, one per language.

Text becomes lower-cased letters and marks with one blank for all else. Counts of ``order``-grams come from a
bounded sample of the labelled rows (about ``sample`` whole texts per language, chosen by a hash of the text, of
the ``max_languages`` most frequent languages); the lower orders, their contexts and the discounts are DataFrame
aggregations of those counts. The model is a sorted array of hashes per order with one column per language; its
size is bounded by the sample, and it is all that is broadcast. Scoring is one pass over whole texts: each
different gram of a chunk is evaluated once, and a text's cross-entropies are sums over its grams.

A second sample, disjoint from the first, calibrates: ``score`` is the softmax of the negative length-normalised
cross-entropies at the sharpness that fits its labels best, and a text is ``rejected`` when its cross-entropy in
the chosen language is further above that language's median, in relation to it, than ``MARGIN`` times the conformal
``KEPT`` quantile of calibration texts of like length (within a factor of four). Languages with fewer than ``ENOUGH``
such texts share the quantile of all languages, and lengths with fewer the one of the nearest length, which grows with
the square root as texts get shorter. With fewer in every length, twice the largest but for one in a hundred stands for the quantile. ``rejected`` never changes ``lang_pred``.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and is rejected; without labelled
rows every text is ``und``; ties go to the smaller language name; a null id is passed on and never learned from;
repeated rows each have a result; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quillspan.llm import words as W
from quillspan.llm.common import by_batch, cut
from quillspan.llm.registry import query, table

ORDER, SAMPLE, MAX_LANGUAGES = 5, 2000, 200
KEPT, ENOUGH, MARGIN, CLASSES = 0.995, 400, 1.25, 20
UNKNOWN = "und"
_BLANK = 32
_CHUNK = W.CHUNK // 4
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower-case letter or mark, or a blank; whether it is a letter, not a mark."""
    out, is_letter = np.full(0x110000, _BLANK, np.uint32), np.zeros(0x110000, bool)
    for c in range(0x80, 0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM":
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
            is_letter[c] = kind == "L"
    for c in range(26):
        out[65 + c] = out[97 + c] = 97 + c
        is_letter[65 + c] = is_letter[97 + c] = True
    return out, is_letter


def _stream(data: np.ndarray, offsets: np.ndarray, order: int):
    """Letters of all texts in one array, each text after ``order - 1`` blanks; places and texts of what is predicted."""
    data = data[offsets[0] : offsets[-1]]
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets - offsets[0]]
    lower, counted = _letters()
    letters = lower[points]
    is_letter = letters != _BLANK
    before = np.concatenate([[False], is_letter[:-1]]) if len(letters) else is_letter
    before[heads[:-1][heads[:-1] < len(letters)]] = False
    kept = np.flatnonzero(is_letter | before)
    rows = np.searchsorted(heads, kept, side="right") - 1
    out = np.full(len(kept) + (order - 1) * (len(offsets) - 1), _BLANK, np.uint32)
    at = np.arange(len(kept)) + (order - 1) * (rows + 1)
    out[at] = letters[kept]
    return out, at, rows, np.bincount(rows[counted[points[kept]]], minlength=len(offsets) - 1)


def _hash(grams: np.ndarray) -> np.ndarray:
    """Hashes of the rows of a matrix of code points."""
    h = np.full(len(grams), grams.shape[1], np.uint64)
    for j in range(grams.shape[1]):
        h = h * _BASE + grams[:, j].astype(np.uint64) + np.uint64(1)
    return W.mix(h)


def _distinct(out: np.ndarray, at: np.ndarray, order: int):
    """The different grams that end at ``at``, as a matrix, and which of them each place has."""
    h = np.zeros(len(at), np.uint64)
    for j in range(order):
        h = h * _BASE + out[at - (order - 1) + j].astype(np.uint64) + np.uint64(1)
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    return out[at[first][:, None] + np.arange(1 - order, 1)[None, :]], which


@dataclass
class Model:
    """For each order the sorted hashes of its grams and of its contexts, with a value per language."""

    languages: list[str]
    order: int
    grams: list  # (hashes, share of the discounted count) by order
    contexts: list  # (hashes, weight of the lower order) by order
    floor: np.ndarray  # probability of a character by order 0
    sharpness: float = 10.0
    medians: np.ndarray | None = None  # of the cross-entropy by language
    limits: np.ndarray | None = None  # how far above, in medians, by language and class of length

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        p = np.repeat(self.floor[None, :], len(grams), axis=0)
        for k in range(1, self.order + 1):
            share = _look_up(*self.grams[k - 1], _hash(grams[:, self.order - k :]), 0.0)
            weight = _look_up(*self.contexts[k - 1], _hash(grams[:, self.order - k : self.order - 1]), 1.0)
            p = share + weight * p
        return np.log(p)

    def cross_entropies(self, data: np.ndarray, offsets: np.ndarray):
        """Of each text in each language; its number of predicted characters, and of letters."""
        out, at, rows, letters = _stream(data, offsets, self.order)
        n = np.bincount(rows, minlength=len(offsets) - 1)
        total = np.zeros((len(n), len(self.languages)))
        if len(at):
            grams, which = _distinct(out, at, self.order)
            logs = self.log_probability(grams)
            for i in range(len(self.languages)):
                total[:, i] = -np.bincount(rows, logs[which, i], len(n))
        return total / np.maximum(n, 1)[:, None], n, letters


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return np.where((keys[at] == wanted)[:, None], values[at], missing) if len(keys) else np.full((len(wanted), values.shape[1]), missing)


def _table(rows: pa.Table, text: str, value: str, languages: int, missing: float, size: int):
    """Sorted hashes and a column of values per language."""
    texts = rows[text].to_pylist()
    grams = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), size)
    keys, which = np.unique(_hash(grams), return_inverse=True)
    values = np.full((len(keys), languages), missing)
    values[which, rows["lang"].to_numpy()] = rows[value].to_numpy()
    return keys, values


def _count(order: int):
    def work(batch):
        langs = batch.column("lang").to_numpy()
        data, offsets = W.buffers(batch.column("text"))
        for a in range(0, len(langs), 200):
            part = offsets[a : a + 201]
            out, at, rows, _ = _stream(data, part, order)
            for lang in np.unique(langs[a : a + 200]):
                mine = at[langs[a + rows] == lang]
                if len(mine):
                    grams, which = _distinct(out, mine, order)
                    text = grams.astype("<u4").tobytes().decode("utf-32-le")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(grams), lang, np.int32)),
                            pa.array([text[i : i + order] for i in range(0, len(text), order)]),
                            pa.array(np.bincount(which).astype(np.int64)),
                        ],
                        names=["lang", "gram", "n"],
                    )

    return work


def train(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", order: int = ORDER, sample: int = SAMPLE, max_languages: int = MAX_LANGUAGES) -> Model:
    """Learn from the rows whose text and language are not null."""
    rows = labelled.select(labelled[text_col].cast("string").alias("text"), labelled[lang_col].cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    languages = sorted(r["lang"] for r in sizes)
    spark = labelled.sparkSession
    shares = spark.createDataFrame([(languages.index(r["lang"]), r["lang"], sample * 4 / 3 / r["count"]) for r in sizes], "i int, lang string, share double")
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.join(F.broadcast(shares), "lang").withColumn("draw", draw).where("draw < share")  # at most max_languages rows
    part = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(4))  # three quarters to learn, one to calibrate
    chosen = cut(chosen.select(F.col("i").alias("lang"), "text", (part == 0).alias("calibrates")), "sample")

    counts = by_batch(chosen.where("not calibrates").select("lang", "text"), "lang int, gram string, n bigint", _count(order))
    level = cut(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    grams, contexts = [], []
    for k in range(order, 0, -1):
        ctx = F.expr(f"substring(gram, 1, {k - 1})")
        discount = level.groupBy("lang").agg(F.try_divide(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 1) + 2 * F.count_if(F.col("n") == 2)).alias("d"))
        discount = discount.select("lang", F.least(F.lit(0.95), F.greatest(F.lit(0.1), F.coalesce("d", F.lit(0.5)))).alias("d"))
        sums = level.groupBy("lang", ctx.alias("ctx")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
        joined = level.withColumn("ctx", ctx).join(sums, ["lang", "ctx"]).join(discount, "lang")
        share = joined.select("lang", "gram", (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("v")).toArrow()
        weight = sums.join(discount, "lang").select("lang", "ctx", (F.col("d") * F.col("types") / F.col("total")).alias("v")).toArrow()
        grams.insert(0, _table(share, "gram", "v", len(languages), 0.0, k))
        contexts.insert(0, _table(weight, "ctx", "v", len(languages), 1.0, k - 1))
        if k > 1:  # a lower order counts in how many places to the left a gram is continued
            level = cut(level.groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n")), "grams")
    letters = (grams[0][1] > 0).sum(axis=0) if len(languages) else np.zeros(0)
    model = Model(languages, order, grams, contexts, 1.0 / (letters + 1000.0))
    return _calibrated(model, chosen.where("calibrates").select("lang", "text"))


def _calibrated(model: Model, held: DataFrame) -> Model:
    """Fit the sharpness and the limits on a bounded sample."""
    n_languages = len(model.languages)
    if not n_languages:
        return model
    shared = held.sparkSession.sparkContext.broadcast(model)

    def work(batch):
        data, offsets = W.buffers(batch.column("text"))
        for a in range(0, batch.num_rows, 500):
            part = batch.slice(a, 500)
            entropy, n, _ = shared.value.cross_entropies(data, offsets[a : a + part.num_rows + 1])
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array(n, pa.int64()), pa.array(list(entropy), pa.list_(pa.float64()))], names=["lang", "n", "h"]
            )

    seen = by_batch(held, "lang int, n bigint, h array<double>", work).where("n > 0").toArrow()
    lang, n = seen["lang"].to_numpy(), seen["n"].to_numpy()
    h = np.array(seen["h"].to_pylist()).reshape(len(lang), n_languages)
    own = h[np.arange(len(lang)), lang]

    def loss(sharpness):
        return np.mean(np.log(np.exp(-sharpness * (h - own[:, None])).sum(axis=1))) if len(lang) else sharpness

    model.sharpness = float(min((1.0, 2.0, 4.0, 8.0, 16.0, 32.0), key=loss))
    if not len(lang):
        return model
    present = np.unique(lang)
    medians = np.array([np.median(own[lang == i]) for i in present])
    model.medians = np.full(n_languages, np.median(medians))
    model.medians[present] = medians
    model.limits = _limits(lang, n, own / model.medians[lang] - 1, n_languages)
    return model


def _class_of(n: np.ndarray) -> np.ndarray:
    """Lengths within a factor of four."""
    return np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64) // 2, CLASSES - 1)


def _quantile(values: np.ndarray) -> float:
    """The conformal quantile: a further value is above it with a chance of ``1 - KEPT`` at most, if there are enough."""
    return max(0.0, float(np.sort(values)[min(len(values), int(np.ceil((len(values) + 1) * KEPT))) - 1]))


def _limits(lang: np.ndarray, n: np.ndarray, above: np.ndarray, n_languages: int) -> np.ndarray:
    """By language and class of length, from calibration texts that are ``above`` their language's median."""
    of = _class_of(n)
    classes = np.arange(CLASSES)
    sizes = np.bincount(of, minlength=CLASSES)
    known = np.flatnonzero(sizes >= ENOUGH)
    if len(known):
        nearest = known[np.abs(known[None, :] - classes[:, None]).argmin(axis=1)]
        pooled = {c: _quantile(above[of == c]) for c in known}
        shared = np.array([pooled[c] for c in nearest]) * 2.0 ** np.maximum(nearest - classes, 0)
    else:  # too few at all: twice the largest but for one in a hundred, as for the shorter texts among them
        typical = 2 * max(0.1, float(np.sort(above)[len(above) - 1 - len(above) // 100]))
        shared = typical * 2.0 ** np.maximum(int(np.sort(of)[len(of) // 4]) - classes, 0)
    limits = np.repeat(shared[None, :], n_languages, axis=0)
    for i in range(n_languages):
        for c in known:
            mine = (lang == i) & (of == c)
            if mine.sum() >= ENOUGH:
                limits[i, c] = _quantile(above[mine])
    return MARGIN * limits


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each document with ``lang_pred, score, cross_entropy, rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A text that is kept passes through the tasks once.
    whole = docs.schema[text_col].dataType == T.StringType()
    other = [c for c in keep if not (whole and c == text_col)]
    rows = docs.select(*(docs[c].alias(f"k_{c}") for c in other), docs[text_col].cast("string").alias("_text"))
    kept = [f"k_{c}" for c in other] + ["_text"] * (len(other) < len(keep))

    def work(batch):
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        data, offsets = W.buffers(batch.column("_text"))
        a = 0
        while a < batch.num_rows:
            b = min(max(a + 1, int(np.searchsorted(offsets, offsets[a] + _CHUNK, side="right")) - 1), a + W.CHUNK_ROWS, batch.num_rows)
            part = batch.slice(a, b - a)
            best, score, own, odd = np.full(b - a, len(model.languages)), np.zeros(b - a), np.zeros(b - a), np.ones(b - a, bool)
            if model.languages:
                h, n, letters = model.cross_entropies(data, offsets[a : b + 1])
                known = letters > 0
                top = h.argmin(axis=1)
                low = h.min(axis=1)
                best = np.where(known, top, best)
                score = np.where(known, 1 / np.exp(-model.sharpness * (h - low[:, None])).sum(axis=1), 0.0)
                own = np.where(known, low, 0.0)
                odd = ~known
                if model.limits is not None:
                    odd |= low / model.medians[top] - 1 > model.limits[top, _class_of(n)]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(names[best], pa.string()), pa.array(score), pa.array(own), pa.array(odd)],
                names=[*kept, "lang_pred", "score", "cross_entropy", "rejected"],
            )
            a = b

    types = ", ".join(f"`{c}` {t}" for c, t in rows.select(*kept).dtypes)
    found = by_batch(rows, f"{types}, lang_pred string, score double, cross_entropy double, rejected boolean", work)
    return found.select(*(F.col(f"k_{c}" if c in other else "_text").alias(c) for c in keep), "lang_pred", "score", "cross_entropy", "rejected")


def bucket_of(id_column, parts: int):
    """The remainder of the CRC-32 of an id's text; null ids have none."""
    return F.crc32(id_column.cast("string").cast("binary")) % parts


@query("op8_language")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(bucket_of(F.col("doc_id"), 5) != 0))
    found = identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", F.coalesce(bucket_of(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
