"""Full-text clauses scored with BM25 over the searched collection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspan.functions import text as ta
from quillspan.functions.logic import any_of, total
from quillspan.operators.clauses import Bound, Clause, all_terms, bool_, boosted, names_of, present, required_matches, worth


def match(
    field: str,
    text: str,
    operator: str = "or",
    minimum_should_match=None,
    type: str = "boolean",
    name: str | None = None,
    boost: float = 1.0,
) -> Clause | None:
    """Documents whose analyzed field holds the terms of ``text``; an empty text asks for nothing.

    ``operator`` is "or" or "and"; ``type`` may be "phrase" or "phrase_prefix".  Scores count times ``boost``.
    """
    if not text:
        return None
    if type == "phrase":
        return phrase(field, text, name=name, boost=boost)
    if type == "phrase_prefix":
        return phrase_prefix(field, text, name=name, boost=boost)
    if type != "boolean" or operator not in ("or", "and"):
        raise ValueError(f"unknown match type {type!r} or operator {operator!r}")
    wanted = ta.distinct_in_order(ta.query_tokens(text))
    if not wanted:
        return Clause(lambda c: Bound(F.lit(False), F.lit(0.0))).named(name)

    def bind(c):
        if minimum_should_match is None:
            held = c.holds_any(field, wanted) if operator == "or" else c.holds_every(field, wanted)
            return boosted(_scored(c, field, wanted, held), boost)
        held = [c.holds_any(field, [t]) for t in wanted]
        need = max(1, required_matches(minimum_should_match, len(wanted)))
        found = total([F.coalesce(h, F.lit(False)).cast("int") for h in held])
        return boosted(_scored(c, field, wanted, found >= need), boost)

    return Clause(bind, frozenset((field, t) for t in wanted)).named(name)


def phrase(field: str, text: str, name: str | None = None, boost: float = 1.0) -> Clause | None:
    """The terms of ``text`` stand next to each other in that order."""
    return _run("phrase", field, text, False, name, boost)


def phrase_prefix(field: str, text: str, name: str | None = None, boost: float = 1.0) -> Clause | None:
    """As :func:`phrase`, with the last term standing for any token it begins."""
    return _run("phrase_prefix", field, text, True, name, boost)


def _run(label: str, field: str, text: str, last_is_prefix: bool, name: str | None, boost: float) -> Clause | None:
    if not text:
        return None
    wanted = ta.query_tokens(text)
    if not wanted:
        return Clause(lambda c: Bound(F.lit(False), F.lit(0.0))).named(name)
    whole = ta.distinct_in_order(wanted[:-1] if last_is_prefix else wanted)

    def bind(c):
        matches = c.holds_run(field, wanted, last_is_prefix)
        if not whole:
            return boosted(Bound(matches, F.lit(1.0), parts=((f"{label}({field})", F.lit(1.0)),)), boost)
        return boosted(_scored(c, field, whole, matches), boost)

    return Clause(bind, frozenset((field, t) for t in whole)).named(name)


def _scored(c, field: str, wanted: list[str], matches: Column) -> Bound:
    scores = [c.term_score(field, t) for t in wanted]
    return Bound(matches, total(scores), parts=tuple((f"{field}:{t}", s) for t, s in zip(wanted, scores)))


def multi_match(
    fields: list[str],
    text: str,
    operator: str = "or",
    type: str = "best_fields",
    tie_breaker: float = 0.0,
    name: str | None = None,
    minimum_should_match=None,
    boost: float = 1.0,
) -> Clause:
    """:func:`match` over several fields; the best field counts, the others by ``tie_breaker``.

    ``"title^2"`` counts a field twice; the minimum holds in each field by itself.  An empty text matches nothing.
    """
    kind = "boolean" if type == "best_fields" else type
    weighted = [(f, float(weight or 1)) for f, _, weight in (f.partition("^") for f in fields)]
    inner = present(
        [match(f, text, operator, minimum_should_match, type=kind, boost=weight) for f, weight in weighted]
    )
    if not inner:
        return Clause(lambda c: Bound(F.lit(False), F.lit(0.0))).named(name)
    return dis_max(inner, tie_breaker=tie_breaker, boost=boost).named(name)


def text_query(
    fields: list[str],
    all_terms: str = "",
    any_terms: str = "",
    none_terms: str = "",
    phrase_text: str = "",
    name: str | None = None,
) -> Clause | None:
    """A text search stated as parts: all, any and none of some terms, and a phrase."""
    if not (all_terms or any_terms or none_terms or phrase_text):
        return None
    parts = [
        multi_match(fields, all_terms, operator="and") if all_terms else None,
        multi_match(fields, any_terms) if any_terms else None,
        multi_match(fields, phrase_text, type="phrase") if phrase_text else None,
    ]
    return bool_(
        must=parts,
        must_not=multi_match(fields, none_terms) if none_terms else None,
        name=name,
    )


def dis_max(queries, tie_breaker: float = 0.0, boost: float = 1.0, name: str | None = None) -> Clause:
    """Documents any query matches, scored (best + tie_breaker x the others) x boost."""
    inner = present(queries)

    def bind(collection):
        bounds = [q.bind(collection) for q in inner]
        if not bounds:
            return Bound(F.lit(False), F.lit(0.0))
        scores = [worth(b) for b in bounds]
        best = F.greatest(*scores) if len(scores) > 1 else scores[0]
        score = best
        if tie_breaker:
            score = best + (total(scores) - best) * tie_breaker
        if boost != 1.0:
            score = score * boost
        return Bound(
            any_of([b.matches for b in bounds]),
            score,
            names_of(bounds),
            tuple(p for b in bounds for p in b.parts),
        )

    return Clause(bind, all_terms(inner)).named(name)
