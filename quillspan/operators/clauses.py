"""Query clauses: what a document must look like, and how much it is worth.

A clause is bound to a collection and gives two columns: a predicate and a score that holds
where the predicate is true.  Predicates stay three-valued so that scans can use them; a
missing value is turned into "no match" only where it would be negated, counted or shown.

Constructors drop clauses that ask for nothing by returning ``None``; every combinator
skips ``None``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.functions import geo
from quillspan.functions.logic import all_of, any_of, total

if TYPE_CHECKING:
    from quillspan.operators.collection import Collection

NAME_DELIMITER = "##"
COMPARISONS = {
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
}


@dataclass(frozen=True)
class Bound:
    """A clause applied to one collection."""

    matches: Column
    score: Column
    named: tuple[tuple[str, Column], ...] = ()
    parts: tuple[tuple[str, Column], ...] = ()

    @property
    def sure(self) -> Column:
        return F.coalesce(self.matches, F.lit(False))


@dataclass(frozen=True)
class Clause:
    """``terms`` are the (field, token) pairs whose corpus statistics the score needs."""

    bind: Callable[[Collection], Bound]
    terms: frozenset = field(default_factory=frozenset)

    def named(self, name: str | None) -> "Clause":
        """Report ``name`` for the documents this clause matches; text from ``##`` on is dropped."""
        if not name:
            return self
        shown = name.split(NAME_DELIMITER, 1)[0]
        inner = self.bind

        def bind(collection):
            bound = inner(collection)
            return replace(bound, named=((shown, bound.sure), *bound.named))

        return replace(self, bind=bind)


def present(clauses) -> list[Clause]:
    """One clause, a list of clauses or ``None``, as a list without the ``None`` ones."""
    if clauses is None:
        return []
    if isinstance(clauses, Clause):
        return [clauses]
    return [c for c in clauses if c is not None]


def all_terms(clauses: Iterable[Clause]) -> frozenset:
    return frozenset().union(*[c.terms for c in clauses])


def worth(bound: Bound) -> Column:
    """The clause's score where it matches, else 0."""
    return F.when(bound.matches, bound.score).otherwise(F.lit(0.0))


def boosted(bound: Bound, boost: float) -> Bound:
    """The same matches with score and contributions times ``boost``."""
    if boost == 1.0:
        return bound
    return replace(bound, score=bound.score * boost, parts=tuple((label, v * boost) for label, v in bound.parts))


def _predicate(label: str, make: Callable[[Collection], Column], name: str | None, boost: float = 1.0) -> Clause:
    def bind(collection):
        matches = make(collection)
        score = F.lit(float(boost))
        return Bound(matches, score, parts=((label, F.when(matches, score).otherwise(F.lit(0.0))),))

    return Clause(bind).named(name)


def match_all(name: str | None = None) -> Clause:
    return _predicate("match_all", lambda c: F.lit(True), name)


def term(field: str, value, name: str | None = None, boost: float = 1.0) -> Clause:
    """The field equals ``value``; an array field holds it.  A match is worth ``boost``."""

    def make(c):
        return F.array_contains(c.column(field), value) if c.is_array(field) else c.column(field, value) == F.lit(value)

    return _predicate(f"term({field})", make, name, boost)


def terms(field: str, values: Iterable, name: str | None = None, boost: float = 1.0) -> Clause:
    """The field equals one of ``values``; no values match nothing.  A match is worth ``boost``."""
    wanted = list(dict.fromkeys(values))

    def make(c):
        if not wanted:
            return F.lit(False)
        if c.is_array(field):
            return F.arrays_overlap(c.column(field), F.array(*[F.lit(v) for v in wanted]))
        return c.column(field, wanted[0]).isin(wanted)

    return _predicate(f"terms({field})", make, name, boost)


def range_(field: str, lower: tuple[str, object], upper: tuple[str, object] | None = None, name: str | None = None) -> Clause:
    """One or two bounds ``(op, value)`` with op gt, gte, lt or lte; of two with one op the second holds."""
    bounds = dict([lower] if upper is None else [lower, upper])
    unknown = set(bounds) - set(COMPARISONS)
    if unknown:
        raise ValueError(f"unknown comparison {sorted(unknown)}; use {sorted(COMPARISONS)}")

    def make(c):
        return all_of([COMPARISONS[op](c.column(field, v), F.lit(v)) for op, v in bounds.items()])

    return _predicate(f"range({field})", make, name)


def prefix(field: str, text: str, name: str | None = None) -> Clause | None:
    """The field starts with ``text``; an empty text asks for nothing."""
    if not text:
        return None
    return _predicate(f"prefix({field})", lambda c: c.column(field).startswith(text), name)


def geo_distance(field: str, lat, lon, distance: str, name: str | None = None) -> Clause:
    """The point ``field.lat, field.lon`` lies within ``distance`` (such as ``"100km"``) of a place."""
    lat0, lon0, reach = float(lat), float(lon), geo.metres(distance)

    def make(c):
        at = c.column(f"{field}.lat", lat0), c.column(f"{field}.lon", lon0)
        return geo.bounding_box(*at, lat0, lon0, reach) & (geo.haversine_m(*at, lat0, lon0) <= reach)

    return _predicate(f"geo_distance({field})", make, name)


def terms_lookup(field: str, lookup: DataFrame, path: str, name: str | None = None) -> Clause:
    """The field equals a value found at ``path`` of the lookup documents (a scalar or an array).

    The lookup rows become a set of values; membership is an EXISTS subquery, which Spark runs
    as a semi, anti or existence join and broadcasts only if the set is small. An array field matches
    if one of its elements is such a value: the elements of its different arrays meet the set in a semi join, and
    documents are then matched by their arrays, so no pair of a document and a value is ever tried.
    """
    shape = lookup.select(path).schema[0].dataType
    value = F.explode(F.col(path)) if isinstance(shape, T.ArrayType) else F.col(path)
    wanted = lookup.select(value.alias("_wanted")).where(F.col("_wanted").isNotNull()).distinct()

    def make(c):
        if not c.is_array(field):
            return wanted.where(F.col("_wanted") == c.column(field).outer()).exists()
        arrays = c.df.select(c.column(field).alias("_array")).distinct()
        elements = arrays.select("_array", F.explode("_array").alias("_element")).distinct()
        holding = elements.join(wanted, F.col("_element") == F.col("_wanted"), "left_semi").select("_array").distinct()
        return holding.where(F.col("_array") == c.column(field).outer()).exists()

    return _predicate(f"terms_lookup({field})", make, name)


def or_filter(filters: Iterable[Clause | None], name: str | None = None) -> Clause:
    """At least one filter matches; no filters match nothing.  All matches score 1."""
    inner = present(filters)

    def bind(collection):
        bounds = [f.bind(collection.unscored()) for f in inner]
        return Bound(any_of([b.matches for b in bounds]), F.lit(1.0), names_of(bounds))

    return Clause(bind).named(name)


def required_matches(minimum, count: int) -> int:
    """``3`` or ``"75%"`` (rounded down) of ``count`` clauses."""
    if isinstance(minimum, str) and minimum.strip().endswith("%"):
        return int(float(minimum.strip()[:-1]) * count // 100)
    return int(minimum)


def bool_(
    must=None, should=None, must_not=None, minimum_should_match=None, name: str | None = None, boost: float = 1.0
) -> Clause | None:
    """All of ``must``, enough of ``should`` and none of ``must_not``; nothing asked gives ``None``.

    Without a stated minimum one ``should`` clause has to match if there is no ``must`` clause,
    else none.  The score is the sum over matching ``must`` and ``should`` clauses, and 1 if
    there are neither, each times ``boost``.
    """
    musts, shoulds, nots = present(must), present(should), present(must_not)
    if not (musts or shoulds or nots):
        return None
    if minimum_should_match is None:
        minimum = 1 if shoulds and not musts else 0
    else:
        minimum = required_matches(minimum_should_match, len(shoulds))

    def bind(collection):
        m, s = ([c.bind(collection) for c in group] for group in (musts, shoulds))
        n = [c.bind(collection.unscored()) for c in nots]
        conditions = [b.matches for b in m]
        if minimum == 1:
            conditions.append(any_of([b.matches for b in s]))
        elif minimum > 1:
            conditions.append(total([b.sure.cast("int") for b in s]) >= minimum if s else F.lit(False))
        conditions += [~b.sure for b in n]
        scored = [*m, *s]
        score = total([b.score for b in m] + [worth(b) for b in s]) if scored else F.lit(1.0)
        bound = Bound(all_of(conditions), score, names_of([*m, *s, *n]), tuple(p for b in scored for p in b.parts))
        return boosted(bound, boost)

    return Clause(bind, all_terms([*musts, *shoulds])).named(name)


def filtered(query: Clause | None, condition: Clause | None) -> Clause | None:
    """``query`` narrowed by ``condition``, which never changes the score."""
    if condition is None:
        return query

    def bind(collection):
        f = condition.bind(collection.unscored())
        if query is None:
            return Bound(f.matches, F.lit(1.0), f.named)
        q = query.bind(collection)
        return Bound(f.matches & q.matches, q.score, q.named + f.named, q.parts)

    return Clause(bind, all_terms(present(query)))


def template(make: Callable[..., Clause | None] | None, params: dict | None = None) -> Clause | None:
    """A clause made by a function of named parameters; no function gives no clause."""
    return None if make is None else make(**(params or {}))


def names_of(bounds: Iterable[Bound]) -> tuple[tuple[str, Column], ...]:
    return tuple(n for b in bounds for n in b.named)

