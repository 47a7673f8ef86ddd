"""Searching a collection: matching documents, their order, totals and aggregations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan.functions.fields import field_column, in_source
from quillspan.operators.aggs import run_aggs
from quillspan.operators.clauses import Clause, bool_, filtered, match_all, present
from quillspan.operators.collection import Collection, Unscored
from quillspan.plans.rowindex import with_row_index

DEFAULT_SIZE = 10
SCORE_DIGITS = 6
TOP_K_ROWS = 100_000


@dataclass(frozen=True)
class SearchResult:
    """Three lazy views of one search.

    ``hits``: the page of documents; ``summary``: one row ``total, max_score`` over all
    matching documents; ``aggs``: rows ``agg, key, doc_count``, or ``None`` if none were asked.
    """

    hits: DataFrame
    summary: DataFrame
    aggs: DataFrame | None


def sort_columns(sort: list[tuple[str, str]], id_col: str) -> list[Column]:
    """``[(field, "asc" | "desc"), ...]`` with missing values last and the id as last word."""
    order = []
    for field, direction in sort:
        if direction not in ("asc", "desc"):
            raise ValueError(f"order of {field!r} must be 'asc' or 'desc'")
        order.append(F.col(field).asc_nulls_last() if direction == "asc" else F.col(field).desc_nulls_last())
    return [*order, F.col(id_col).asc()]


def of_type(df: DataFrame, type_name: str | None, type_col: str = "_type") -> DataFrame:
    """Documents of one type; no name means all types."""
    return df.where(F.col(type_col) == type_name) if type_name else df


def search(
    df: DataFrame,
    id_col: str = "_id",
    query: Clause | list | None = None,
    filter: Clause | list | None = None,
    post_filter: Clause | list | None = None,
    aggs: dict | None = None,
    sort: list[tuple[str, str]] | None = None,
    size: int | None = DEFAULT_SIZE,
    from_: int = 0,
    type_name: str | None = None,
    type_col: str = "_type",
    fields: list[str] | None = None,
    explain: bool = False,
    token_columns: dict[str, str] | None = None,
) -> SearchResult:
    """Run clauses over a collection.

    Several clauses of one kind must all match.  ``filter`` narrows without scoring;
    ``post_filter`` narrows hits and totals but not aggregations.  Hits come by score unless
    ``sort`` is given, in which case no score is computed.  ``size=None`` returns every hit,
    unordered unless ``sort`` asks for an order; hits before ``from_`` then count by id.  A field that is
    no column is looked up in the JSON documents of ``_source``, as text; see ``mapped`` for types.
    """
    base = of_type(df, type_name, type_col)
    asked = bool_(must=present(query)) or match_all()
    narrowed = filtered(asked, bool_(must=present(filter)))
    after = bool_(must=present(post_filter))
    scored = not sort
    tests = Unscored(base, token_columns=token_columns)
    matched = base.where(narrowed.bind(tests).matches)
    late = after.bind(tests) if after else None
    worded, bound = matched, narrowed.bind(tests)
    if scored or explain:
        # Scores read the words of a document several times: put them in a column first.
        at = dict(token_columns or {})
        for i, field in enumerate(sorted({f for f, _ in asked.terms} - set(at))):
            at[field] = f"_words_{i}"
            worded = worded.withColumn(at[field], tests.tokens(field))
        bound = narrowed.bind(Collection(base, asked.terms, token_columns, read_from=at))

    wanted = worded.where(late.matches) if late else worded

    score = F.round(bound.score, SCORE_DIGITS) if scored else F.lit(None).cast("double")
    listed = list(fields if fields is not None else df.columns)
    if id_col not in listed:
        listed.insert(0, id_col)
    output = [field_column(df, f).alias(f) if in_source(df, f) else F.col(f) for f in listed]
    output.append(score.alias("score"))
    names = [*bound.named, *(late.named if late else ())]
    if names:
        output.append(
            F.array_compact(F.array(*[F.when(test, F.lit(n)) for n, test in names])).alias("matched_queries")
        )
    if explain:
        output.append(explanation(bound.parts).alias("explanation"))

    added = {"score", *(["matched_queries"] if names else []), *(["explanation"] if explain else [])}
    if added & {f.lower() for f in listed}:
        raise ValueError(f"hits get columns {sorted(added)}; rename those of the collection or leave them out of fields")
    # Sort keys that are not shown travel under names of their own.
    keys = [(f if f in listed and not in_source(df, f) else f"_sort_{i}", way) for i, (f, way) in enumerate(sort or [])]
    if sort:
        order = sort_columns(keys, id_col)
    elif size is not None:
        order = [F.col("score").desc(), F.col(id_col).asc()]
    else:
        order = [F.col(id_col).asc()] if from_ else []
    sort_only = {key: field_column(df, f).alias(key) for (key, _), (f, _) in zip(keys, sort or []) if key != f}
    hits = wanted.select(*output, *sort_only.values())
    hits = _page(hits, order, from_, size).drop(*sort_only)

    summary = wanted.select(score.alias("score")).agg(
        F.count(F.lit(1)).alias("total"), F.max("score").alias("max_score")
    )
    return SearchResult(hits, summary, run_aggs(matched, aggs) if aggs else None)


def _page(hits: DataFrame, order: list[Column], from_: int, size: int | None) -> DataFrame:
    """The rows from ``from_`` on, ``size`` of them, under ``order``.

    A top-k keeps ``from_ + size`` rows per task and on the driver; a page further in than
    ``TOP_K_ROWS`` is found by numbering all rows in parallel instead.
    """
    if not order:
        return hits
    if size is None and not from_:
        return hits.orderBy(*order)
    if size is not None and from_ + size <= TOP_K_ROWS:
        hits = hits.orderBy(*order)
        return (hits.offset(from_) if from_ else hits).limit(size)
    # An offset alone would gather all rows in one partition.
    place = F.col("_page_row")
    numbered = with_row_index(hits, order, "_page_row").where(place >= from_)
    return (numbered if size is None else numbered.where(place < from_ + size)).orderBy(place).drop("_page_row")


def explanation(parts) -> Column:
    """``map<clause, contribution>``; equal labels add up."""
    sums: dict[str, Column] = {}
    for label, value in parts:
        sums[label] = sums[label] + value if label in sums else value
    if not sums:
        return F.create_map().cast("map<string,double>")
    return F.create_map(*[x for label, v in sums.items() for x in (F.lit(label), F.round(v, SCORE_DIGITS))])


def matching(
    df: DataFrame, query: Clause | list | None, token_columns: dict[str, str] | None = None
) -> DataFrame:
    """The documents that match, unscored: the predicate alone, also over streams."""
    clause = bool_(must=present(query)) or match_all()
    return df.where(clause.bind(Unscored(df, token_columns=token_columns)).matches)


def predicate(df: DataFrame, query: Clause | list | None, token_columns: dict[str, str] | None = None) -> Column:
    """Whether a document of ``df`` matches, never NULL."""
    clause = bool_(must=present(query)) or match_all()
    return clause.bind(Unscored(df, token_columns=token_columns)).sure
