"""Quality rules whose cut-offs are chosen with a bound on the good documents they reject.

Rules compare one measure each with a cut-off. Labelled documents of quality 1 that pass the base rules are the
holdout of their stratum. A cut-off is admissible when the exact binomial test rejects the hypothesis that it
would reject more than ``risk`` of such documents: P(Binomial(n, risk) <= rejected) <= error, where the error of
all tests together, over every stratum, rule and grid point, is ``delta`` (Bonferroni). Of the admissible
cut-offs of a rule the strictest is used; a rule without one does not apply in its stratum. Each rule may use its
share of the risk, so that with probability ``1 - delta`` all rules of a stratum together reject at most ``risk`` of
its good documents.

Only DataFrame functions run. Documents are scanned once for measures (arrays inside their own row); labels are
joined by id; holdouts are counted per stratum and grid point before anything moves, and the cut-offs come back as a
table of a few rows per stratum.

Defined results: a null or empty text has no words and fails the base rules; without labels no rule applies and the
base rules alone decide; a null stratum is one of its own; repeated labels of one id count once, as good only if all
are; null labels are ignored; repeated documents each have a result; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from quillspan.llm.common import cut
from quillspan.llm.registry import query, table

MIN_WORDS, MAX_REPEAT = 50, 50
RISK, DELTA = 0.05, 0.05

#: Rule -> its measure (the larger, the worse) and the grid of cut-offs, from strict to lenient.
RULES = {
    "symbols": ("n_symbols / nullif(n_words, 0)", [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]),
    "dup_lines": ("n_dup_lines / nullif(n_lines, 0)", [0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9]),
    "repeats": ("n_repeat_words / nullif(n_words, 0)", [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5]),
    "long_words": ("word_chars / nullif(n_words, 0)", [6.0, 6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0]),
    "short_words": ("-word_chars / nullif(n_words, 0)", [-5.0, -4.5, -4.0, -3.5, -3.0, -2.5, -2.0, -1.75, -1.5, -1.25]),
}


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""

    def of_grams(grams):
        def of_sorted(order):
            n = F.size(order)
            same = lambda i, j: F.element_at(order, i)["g"] == F.element_at(order, j)["g"]
            marked = F.filter(
                F.sequence(F.lit(1), n),
                lambda i: F.when(i > 1, same(i, F.greatest(i - 1, F.lit(1)))).otherwise(False) | F.when(i < n, same(i, F.least(i + 1, n))).otherwise(False),
            )
            places = F.transform(marked, lambda i: F.element_at(order, i)["i"])
            covered = F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))
            return F.size(F.array_distinct(covered))

        pairs = F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(_let(F.sort_array(pairs), of_sorted))

    grams = lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2))
    )
    return F.when(F.size(words) < 3, 0).otherwise(_let(words, lambda w: F.when(F.size(w) < 3, 0).otherwise(_let(grams(w), of_grams))))


def measures(text: Column) -> dict[str, Column]:
    """Counts of a text, as columns by name."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r")))
    by_line = _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    return {
        "_counts": counts,
        "_lines": by_line,
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
    }


def _cut_offs(held: DataFrame, risk: float, delta: float) -> DataFrame:
    """``stratum, rule, cutoff``: the strictest admissible cut-off of each rule, from the good holdouts' measures."""
    tests = [(name, c) for name, (_, grid) in RULES.items() for c in grid]
    over = [F.count_if(F.expr(RULES[name][0]) > c).alias(f"r{i}") for i, (name, c) in enumerate(tests)]
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *over)
    named = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"r{i}").alias("k")) for i, (name, c) in enumerate(tests)))
    rows = counts.select("stratum", "n", F.inline(named))
    strata = cut(rows, "holdouts")
    n_tests = max(1, strata.count())
    p = risk / len(RULES)
    # P(Binomial(n, p) <= k): terms follow from each other; logarithms keep them from vanishing.
    start = F.struct((F.col("n") * F.log(F.lit(1 - p))).alias("t"), F.lit(0.0).alias("sum"))

    def step(s, i):
        return F.struct(
            (s["t"] + F.log((F.col("n") - i) / (i + 1.0)) + F.lit(math.log(p / (1 - p)))).alias("t"), (s["sum"] + F.exp(s["t"])).alias("sum")
        )

    # Beyond the mean the probability is above any admissible error, so sums end there.
    short = F.col("k") <= F.col("n") * p
    tail = F.aggregate(F.sequence(F.lit(0).cast("long"), F.when(short, F.col("k")).otherwise(F.lit(0))), start, step)["sum"]
    passed = strata.where(short).withColumn("tail", tail).where(F.col("tail") <= delta / n_tests)
    return passed.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def assess(
    docs: DataFrame,
    labels: DataFrame,
    *,
    stratum: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    risk: float = RISK,
    delta: float = DELTA,
) -> DataFrame:
    """One row per document: ``id_col``, its measures, ``base_failed``, the ``rules`` that reject it, ``kept``."""
    m = measures(docs[text_col].cast("string"))
    rows = docs.select(docs[id_col].alias("_id"), F.coalesce(stratum.cast("string"), F.lit("")).alias("stratum"), *(c.alias(k) for k, c in m.items()))
    rows = rows.select(
        "_id",
        "stratum",
        F.col("_counts.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("_lines.n").cast("long").alias("n_lines"),
        F.col("_lines.d").cast("long").alias("n_dup_lines"),
        F.col("_counts.r").cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    rows = cut(rows.withColumn("base_failed", failed), "measures")
    good = labels.select(labels[id_col].alias("_id"), labels[label_col].alias("q")).where("_id is not null and q is not null")
    good = good.groupBy("_id").agg(F.min("q").alias("q")).where("q = 1").select("_id")
    limits = _cut_offs(rows.where("not base_failed").join(good, "_id", "left_semi"), risk, delta)
    limits = cut(limits.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff")), "limits")
    hits = [F.when(F.expr(expr) > F.col(f"limit.{name}"), F.lit(name)) for name, (expr, _) in RULES.items()]
    judged = rows.join(limits.alias("limit"), rows["stratum"] == F.col("limit.stratum"), "left")
    judged = judged.withColumn("rules", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*hits))))
    return judged.select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "rules",
        (~F.col("base_failed") & (F.size("rules") == 0)).alias("kept"),
    )


@query("op7_quality")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = assess(docs, table(spark, sf_dir, "labels"), stratum=docs["lang"])
    return found.withColumn("rules", F.concat_ws(",", "rules"))
