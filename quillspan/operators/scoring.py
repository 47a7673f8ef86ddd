"""Clauses that change scores."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspan.operators.clauses import Bound, Clause, match_all, names_of

DEFAULT_NEGATIVE_BOOST = 0.2


def boosting(
    positive: Clause | None = None,
    negative: Clause | None = None,
    negative_boost: float | None = DEFAULT_NEGATIVE_BOOST,
    name: str | None = None,
) -> Clause | None:
    """``positive`` matches; those that ``negative`` also matches are demoted by ``negative_boost``."""
    if positive is None and negative is None:
        return None
    wanted = positive or match_all()
    factor = DEFAULT_NEGATIVE_BOOST if negative_boost is None else negative_boost

    def bind(collection):
        p = wanted.bind(collection)
        if negative is None:
            return p
        n = negative.bind(collection.unscored())
        demotion = F.when(n.matches, F.lit(float(factor))).otherwise(F.lit(1.0))
        return Bound(p.matches, p.score * demotion, names_of([p, n]), (*p.parts, ("negative_boost", demotion)))

    return Clause(bind, wanted.terms).named(name)


@dataclass(frozen=True)
class ScoreFunction:
    """A factor, a number or any column, for the documents that ``filter`` matches (default all)."""

    weight: float | Column
    filter: Clause | None = None


def function_score(
    query: Clause | None, functions: list[ScoreFunction], score_mode: str, name: str | None = None
) -> Clause:
    """``query``'s score times the combined factors of the functions that apply, or times 1 if none does."""
    if score_mode not in ("multiply", "sum", "avg", "first", "max", "min"):
        raise ValueError(f"unknown score_mode {score_mode!r}")
    base = query or match_all()

    def bind(collection):
        q = base.bind(collection)
        held = [f.filter.bind(collection.unscored()) if f.filter is not None else None for f in functions]
        factors = []
        for f, condition in zip(functions, held):
            weight = f.weight.cast("double") if isinstance(f.weight, Column) else F.lit(float(f.weight))
            factors.append(weight if condition is None else F.when(condition.matches, weight))
        combined = F.coalesce(_combine(factors, score_mode), F.lit(1.0)) if factors else F.lit(1.0)
        return Bound(
            q.matches,
            q.score * combined,
            names_of([q, *[h for h in held if h is not None]]),
            (*q.parts, ("functions", combined)),
        )

    return Clause(bind, base.terms).named(name)


def _combine(factors: list[Column], mode: str) -> Column:
    """Factors that do not apply are NULL; the result is NULL if none applies."""
    if mode == "first" or len(factors) == 1:
        return F.coalesce(*factors)
    if mode == "max":
        return F.greatest(*factors)
    if mode == "min":
        return F.least(*factors)
    applies = F.coalesce(*factors).isNotNull()
    if mode == "multiply":
        return F.when(applies, reduce(lambda a, b: a * b, [F.coalesce(f, F.lit(1.0)) for f in factors]))
    added = reduce(lambda a, b: a + b, [F.coalesce(f, F.lit(0.0)) for f in factors])
    if mode == "sum":
        return F.when(applies, added)
    count = reduce(lambda a, b: a + b, [f.isNotNull().cast("int") for f in factors])
    return F.when(applies, added / count)
