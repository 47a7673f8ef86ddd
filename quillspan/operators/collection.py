"""A collection of documents together with the statistics that relevance needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan.functions import fields, text
from quillspan.functions.logic import all_of

K1 = 1.2
B = 0.75


def inverse_document_frequency(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def bm25(tf: Column, dl: Column, idf: Column, avgdl: Column) -> Column:
    """One term's weight in one document; 0 if the term is absent."""
    norm = tf + K1 * ((1 - B) + B * dl / avgdl)
    return F.when(tf > 0, idf * (tf * (K1 + 1)) / norm).otherwise(F.lit(0.0))


class Collection:
    """Columns, tokens and corpus statistics of one DataFrame.

    ``token_columns`` names array columns that already hold the tokens of a text field, so a
    stored, analyzed collection is not tokenized again.  ``read_from`` names such columns for
    the scores alone, where the scored rows have more of them than the collection.
    """

    def __init__(
        self,
        df: DataFrame,
        terms=frozenset(),
        token_columns: dict[str, str] | None = None,
        read_from: dict[str, str] | None = None,
    ):
        self.df = df
        self.token_columns = token_columns or {}
        self._terms = sorted(terms)
        self._stats = self._statistics() if self._terms else None
        self.token_columns = read_from or self.token_columns

    def unscored(self) -> Collection:
        """The same collection for clauses whose score nobody reads."""
        return Unscored(self.df, token_columns=self.token_columns)

    def column(self, field: str, like=None) -> Column:
        """A field to be compared with ``like``; one that is no column is looked up in the JSON documents."""
        return fields.field_column(self.df, field, like)

    def is_array(self, field: str) -> bool:
        return fields.is_array(self.df, field)

    def tokens(self, field: str) -> Column:
        if field in self.token_columns:
            return F.col(self.token_columns[field])
        return text.tokens(self.column(field))

    def holds_any(self, field: str, terms: list[str]) -> Column:
        """Whether a text has at least one of ``terms``.

        Stored tokens are looked through; other text is searched in place, once and only up to
        the first find, which is much cheaper than tokenizing it.
        """
        if field in self.token_columns:
            return F.arrays_overlap(self.tokens(field), F.array(*[F.lit(t) for t in terms]))
        return F.lower(self.column(field)).rlike(text.any_regex(terms))

    def holds_every(self, field: str, terms: list[str]) -> Column:
        if field in self.token_columns:
            return all_of([F.array_contains(self.tokens(field), t) for t in terms])
        return F.lower(self.column(field)).rlike(text.every_regex(terms))

    def holds_run(self, field: str, terms: list[str], last_is_prefix: bool) -> Column:
        """Whether ``terms`` are neighbours in a text; the last may stand for what it begins."""
        if field in self.token_columns:
            return text.holds_run(self.tokens(field), terms, last_is_prefix)
        return F.lower(self.column(field)).rlike(text.run_regex(terms, last_is_prefix))

    def _statistics(self) -> Column:
        """One row over the whole collection, read as a scalar subquery: no join, nothing collected."""
        fields = sorted({f for f, _ in self._terms})
        at = {f: f"_t{i}" for i, f in enumerate(fields)}
        words = self.df.select(*[self.tokens(f).alias(at[f]) for f in fields])
        counted = words.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(F.size(at[f])).alias(f"avgdl{i}") for i, f in enumerate(fields)],
            *[F.count_if(F.array_contains(at[f], t)).alias(f"df{i}") for i, (f, t) in enumerate(self._terms)],
        )
        row = counted.select(
            F.struct(
                *[f"avgdl{i}" for i in range(len(fields))],
                *[
                    inverse_document_frequency(F.col("n"), F.col(f"df{i}")).alias(f"idf{i}")
                    for i in range(len(self._terms))
                ],
            ).alias("stats")
        )
        self._avgdl = {f: f"avgdl{i}" for i, f in enumerate(fields)}
        self._idf = {key: f"idf{i}" for i, key in enumerate(self._terms)}
        return row.scalar()

    def term_score(self, field: str, term: str) -> Column:
        words = self.tokens(field)
        return bm25(
            text.term_frequency(words, term).cast("double"),
            F.size(words).cast("double"),
            self._stats[self._idf[(field, term)]],
            self._stats[self._avgdl[field]],
        )


class Unscored(Collection):
    """A collection without statistics: every term is worth 1."""

    def term_score(self, field: str, term: str) -> Column:
        return F.lit(1.0)
