"""Mixing sources to target weights: raking, then sampling by calibrated probabilities.

Documents are summed into cells (one per combination of the dimensions' values) before anything else. A cell gives its
tokens at most, so raking (iterative proportional fitting) is bounded: in turn for each dimension, the weights of the cells
of each value are scaled by the one factor at which ``min(tokens, weight)`` sums to the value's target. That factor is found
exactly, from running sums over the value's cells in order of weight by tokens; a cell that is full in one turn may have room
in the next. Targets are shares of the budget, and a value with too few tokens for its share gives all it has, the others the
rest. Rounds end when every sum is within ``tolerance`` of the budget from its target; targets that contradict each other
use ``rounds`` up, and :func:`margins` shows what is left. The probability of a cell is ``min(1, weight / tokens)``. A
document is drawn when the number in [0, 1) that the MD5 of its id gives is below its probability, so repeated runs, and
repeated rows, agree.

Only DataFrame functions run. What grows with the corpus is one scan that counts words, one aggregation with
partial sums, and one join with the cells, which Spark broadcasts if their size allows and splits if a cell is hot;
raking runs on the cells alone, in windows that spill, and one number per three rounds reaches the driver.

Defined results: null and empty texts have no tokens and take part with their cell's probability; a null value of
a dimension is the value ``(none)``; a value without a target has share 0 and probability 0, unless no value of
the dimension has one, which leaves the dimension as it is; cells without tokens have the probability 1; a null id
draws as the empty text; an empty table gives no rows; other columns are ignored, or kept by ``keep``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillspan.llm.common import cut
from quillspan.llm.registry import query, table

# Most rounds of raking, and the largest departure from a target, as a share of the budget, that ends them.
ROUNDS, TOLERANCE = 60, 1e-9
# Up to this many cells are raked in one task, without shuffles; more are shuffled by the values of each dimension.
CELLS_A_TASK = 1_000_000
NONE = "(none)"


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """A coarse kind of text, from its form alone."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.rlike(r"[#*$%&]{3}"), "markup")
        .when(F.upper(text) == text, "capitals")
        .otherwise("prose")
    )


def tempered(cells: DataFrame, name: str, power: float) -> DataFrame:
    """Targets that flatten the present token shares of a dimension: ``value, share`` with tokens ** power."""
    return cells.groupBy(F.col(name).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("share"))


def _factor(by: list[Column], room: str, weight: str, amount: str) -> tuple[Column, Column]:
    """Each row's candidate (to be called ``_own``) and the factor at which ``min(room, factor * weight)`` sums to ``amount`` over the rows that agree in ``by``.

    With the fullest rows in front, a row's own candidate holds if all before it are full and it is not; the largest
    candidate that holds is the factor. If the room is not enough, every row is filled.
    """
    group = Window.partitionBy(*by)
    order = group.orderBy(F.try_divide(F.col(weight), F.col(room)).desc_nulls_last())
    before = F.coalesce(F.sum(room).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(weight).over(order.rowsBetween(0, Window.unboundedFollowing))
    own = F.try_divide(F.greatest(F.col(amount) - before, F.lit(0.0)), rest)
    held = F.max(F.when(F.col("_own") * F.col(weight) <= F.col(room), F.col("_own"))).over(group)
    filled = F.max(F.try_divide(F.col(room), F.col(weight))).over(group)
    return own, F.coalesce(held, filled, F.lit(0.0))


def _scaled(rows: DataFrame, by: list[Column], room: str, weight: str, amount: str) -> DataFrame:
    own, factor = _factor(by, room, weight, amount)
    return rows.withColumn("_own", own).withColumn(weight, F.col(weight) * factor).drop("_own")


def _filled(room: str, weight: str) -> Column:
    return F.least(F.col(room), F.col(weight))


def rake(cells: DataFrame, targets: dict[str, DataFrame], budget: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (a column per dimension, ``tokens``) with ``t_<dimension>``, the tokens its value is to give, and ``probability``."""
    raked, used = cells.where("tokens > 0").select(*targets, F.col("tokens").cast("double").alias("room")), []
    for name, target in targets.items():
        share = target.groupBy(F.coalesce(F.col("value").cast("string"), F.lit(NONE)).alias(name)).agg(F.max("share").cast("double").alias("share"))
        values = raked.groupBy(name).agg(F.sum("room").alias("held")).join(share, name, "left")
        # Shares count among the values that are there; the first split of the budget is bounded by what each value has.
        values = values.select(name, "held", F.coalesce("share", F.lit(0.0)).alias("part"), F.lit(float(budget)).alias("all"))
        values = cut(_scaled(values, [F.lit(0)], "held", "part", "all").select(name, _filled("held", "part").alias(f"t_{name}")), "targets")
        if values.where(F.col(f"t_{name}") > 0).isEmpty():
            values = values.withColumn(f"t_{name}", F.lit(None).cast("double"))
        else:
            used.append(name)
        raked = raked.join(values, name)
    raked = cut(raked.withColumn("weight", F.col("room")), "cells")
    # A window over one partition needs no shuffle; the result is the same either way.
    together = raked.count() <= CELLS_A_TASK
    raked = raked.coalesce(1) if together else raked
    if not used:
        raked = _scaled(raked.withColumn("all", F.lit(float(budget))), [F.lit(0)], "room", "weight", "all").drop("all")
    for i in range(rounds if used else 0):
        for name in used:
            raked = _scaled(raked, [F.col(name)], "room", "weight", f"t_{name}")
        if i % 3 == 2 or i == rounds - 1:
            raked = cut(raked, "raked")
            raked = raked.coalesce(1) if together else raked
            off = [raked.groupBy(name).agg(F.abs(F.sum(_filled("room", "weight")) - F.first(f"t_{name}")).alias("off")).select("off") for name in used]
            most = reduce(DataFrame.union, off).agg(F.max("off")).first()[0]
            if most is None or most <= tolerance * budget:
                break
    chance = raked.select(*targets, *(f"t_{n}" for n in targets), (_filled("room", "weight") / F.col("room")).alias("probability"))
    return cells.join(chance, list(targets), "left").withColumn("probability", F.when(F.col("tokens") > 0, F.col("probability")).otherwise(1.0))


def margins(cells: DataFrame, names: list[str]) -> DataFrame:
    """``dimension, value, tokens, target, expected`` of raked cells: what every value is to give and what it will on average."""
    expected = F.sum(F.col("tokens") * F.col("probability")).alias("expected")
    parts = [
        cells.where("tokens > 0").groupBy(F.lit(n).alias("dimension"), F.col(n).alias("value")).agg(F.sum("tokens").alias("tokens"), F.first(f"t_{n}").alias("target"), expected)
        for n in names
    ]
    return reduce(DataFrame.union, parts)


def draw(id_column: Column) -> Column:
    """A number in [0, 1) from the id's text."""
    digits = F.substring(F.md5(F.coalesce(id_column.cast("string"), F.lit(""))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 32)


def _calibrated(rows: DataFrame, names: list[str], targets: dict[str, DataFrame] | None, power: float, budget_share: float, rounds: int) -> DataFrame:
    keys = [f"in_{n}" for n in names]
    cells = cut(rows.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")), "cells")
    given = targets or {}
    wanted = {f"in_{n}": given[n] if n in given else tempered(cells, f"in_{n}", power) for n in names}
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    return rake(cells, wanted, budget_share * total, rounds)


def calibrate(
    docs: DataFrame,
    dimensions: dict[str, Column],
    *,
    targets: dict[str, DataFrame] | None = None,
    power: float = 0.7,
    budget_share: float = 0.5,
    rounds: int = ROUNDS,
    text_col: str = "text",
) -> DataFrame:
    """The cells of :func:`mix` as ``in_<name>, tokens, t_in_<name>, probability``, for :func:`margins`."""
    cols = [F.coalesce(c.cast("string"), F.lit(NONE)).alias(f"in_{n}") for n, c in dimensions.items()]
    rows = docs.select(*cols, n_tokens(docs[text_col].cast("string")).alias("n_tokens"))
    return _calibrated(rows, list(dimensions), targets, power, budget_share, rounds)


def mix(
    docs: DataFrame,
    dimensions: dict[str, Column],
    *,
    targets: dict[str, DataFrame] | None = None,
    power: float = 0.7,
    budget_share: float = 0.5,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``keep`` (the id), the dimensions as ``in_<name>``, ``n_tokens, probability, sampled``.

    ``targets`` holds ``value, share`` by dimension; a dimension without gets its present shares, flattened by ``power``.
    """
    keep = [id_col] if keep is None else keep
    names = list(dimensions)
    cols = [F.coalesce(c.cast("string"), F.lit(NONE)).alias(f"in_{n}") for n, c in dimensions.items()]
    rows = docs.select(*(docs[c].alias(f"k_{c}") for c in keep), docs[id_col].alias("_id"), *cols, n_tokens(docs[text_col].cast("string")).alias("n_tokens"))
    keys = [f"in_{n}" for n in names]
    chances = cut(_calibrated(rows, names, targets, power, budget_share, rounds).select(*keys, "probability"), "chances")
    on = reduce(lambda a, b: a & b, [rows[k] == chances[k] for k in keys])
    out = rows.join(chances, on, "left").select(*(F.col(f"k_{c}").alias(c) for c in keep), *(rows[k] for k in keys), "n_tokens", "probability", "_id")
    return out.withColumn("sampled", draw(F.col("_id")) < F.col("probability")).drop("_id")


def _oracle(power: float, budget_share: float) -> str:
    """The same in SQL, with one step of a recursive table per turn of raking."""
    dims = ["source", "lang", "topic"]
    ctes = [
        r"""d AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
            CASE WHEN contains(text, ' | ') THEN 'table' WHEN regexp_matches(text, '[#*$%&]{3}') THEN 'markup'
                 WHEN upper(text) = text THEN 'capitals' ELSE 'prose' END AS topic,
            coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens FROM documents)""",
        "c AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY ALL)",
    ]
    ctes.append(f"b AS (SELECT {budget_share} * sum(tokens) AS b FROM c)")
    own = "greatest({amount} - coalesce(sum({room}) OVER (PARTITION BY {by} ORDER BY {weight} / {room} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) " \
        "/ nullif(sum({weight}) OVER (PARTITION BY {by} ORDER BY {weight} / {room} DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)"
    scaled = "{weight} * coalesce(max(CASE WHEN o * {weight} <= {room} THEN o END) OVER (PARTITION BY {by}), max({room} / nullif({weight}, 0)) OVER (PARTITION BY {by}), 0)"
    for x in dims:
        names = {"by": "1", "room": "held", "weight": "part", "amount": "b"}
        ctes.append(f"s_{x} AS (SELECT {x}, sum(tokens)::DOUBLE AS held, pow(sum(tokens)::DOUBLE, {power}) AS part FROM c WHERE tokens > 0 GROUP BY 1)")
        ctes.append(f"o_{x} AS (SELECT *, {own.format(**names)} AS o FROM s_{x}, b)")
        ctes.append(f"t_{x} AS (SELECT {x}, least(held, {scaled.format(**names)}) AS t_{x} FROM o_{x})")
    names = {"by": "by_value", "room": "room", "weight": "w", "amount": "amount"}
    value = lambda prefix: f"CASE n % 3 WHEN 0 THEN {prefix}source WHEN 1 THEN {prefix}lang ELSE {prefix}topic END"
    ctes.append(
        "r AS (SELECT 0 AS n, source, lang, topic, tokens::DOUBLE AS room, tokens::DOUBLE AS w, t_source, t_lang, t_topic FROM c JOIN t_source USING (source) "
        "JOIN t_lang USING (lang) JOIN t_topic USING (topic) WHERE tokens > 0 UNION ALL "
        f"SELECT n + 1, source, lang, topic, room, {scaled.format(**names)}, t_source, t_lang, t_topic FROM (SELECT *, {own.format(**names)} AS o FROM "
        f"(SELECT *, {value('')} AS by_value, {value('t_')} AS amount FROM r WHERE n < {3 * ROUNDS})))"
    )
    ctes.append(f"p AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN least(room, w) / room ELSE 1.0 END::DOUBLE AS p FROM c LEFT JOIN r USING (source, lang, topic) WHERE n = {3 * ROUNDS} OR n IS NULL)")
    return (
        "WITH RECURSIVE " + ",\n".join(ctes) + " SELECT doc_id, source, lang, topic, n_tokens, round(p, 6) AS probability, "
        "('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT / 4294967296.0::DOUBLE < p AS sampled FROM d JOIN p USING (source, lang, topic)"
    )


@query("op3_mixing", _oracle(0.7, 0.5))
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs, {"source": docs["source"], "lang": docs["lang"], "topic": topic(docs["text"])})
    return mixed.select(
        "doc_id",
        F.col("in_source").alias("source"),
        F.col("in_lang").alias("lang"),
        F.col("in_topic").alias("topic"),
        "n_tokens",
        F.round("probability", 6).alias("probability"),
        "sampled",
    )
