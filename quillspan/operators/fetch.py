"""Reading documents by id, counting them and exporting them in pages."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.functions.fields import field_column, in_source
from quillspan.operators.clauses import Clause
from quillspan.operators.search import DEFAULT_SIZE, of_type, search, sort_columns
from quillspan.plans.rowindex import with_row_index

PAGE_SIZE = 100


def get(df: DataFrame, id_value, id_col: str = "_id", type_col: str | None = "_type") -> DataFrame:
    """One row for one id, with ``found``; of several types holding the id the smallest is read."""
    keep = [c for c in df.columns if c != id_col]
    hit = df.where(F.col(id_col) == F.lit(id_value))
    if type_col and type_col in keep:
        hit = hit.orderBy(type_col)
    hit = hit.limit(1).withColumn("found", F.lit(True))
    asked = df.sparkSession.range(1).select(F.lit(id_value).cast(df.schema[id_col].dataType).alias(id_col))
    return asked.join(hit, id_col, "left").select(
        id_col, F.coalesce("found", F.lit(False)).alias("found"), *keep
    )


def multi_get(
    df: DataFrame,
    ids: list | DataFrame,
    id_col: str = "_id",
    fields: list[str] | None = None,
    type_name: str | None = None,
    type_col: str = "_type",
) -> DataFrame:
    """One row per distinct id, with ``found`` and an ``error`` for the missing ones; of several types the smallest.

    The collection is cut down to the asked ids first, so the outer join that keeps missing ids
    only sees documents that were asked for.  ``ids`` may be a list or a one-column DataFrame.  Fields that are
    no columns are read from the JSON documents of ``_source``.
    """
    keep = [c for c in (fields if fields is not None else df.columns) if c != id_col]
    inside = {f: field_column(df, f) for f in keep if in_source(df, f)}
    docs = of_type(df, type_name, type_col).withColumns(inside)
    id_type = df.schema[id_col].dataType
    if isinstance(ids, DataFrame):
        asked = ids.select(F.col(ids.columns[0]).cast(id_type).alias(id_col)).where(F.col(id_col).isNotNull()).distinct()
        docs = docs.join(asked, id_col, "left_semi")
    else:
        # Ids are compared as the column's own type, so file statistics can prune with them.
        wanted = list(dict.fromkeys(str(i) if isinstance(id_type, T.StringType) else i for i in ids))
        rows = df.sparkSession.createDataFrame([(i,) for i in wanted], f"{id_col} {_literal_type(wanted)}")
        asked = rows.select(F.col(id_col).cast(id_type).alias(id_col)).distinct()
        docs = docs.where(F.col(id_col).isin(wanted) if wanted else F.lit(False))
    if type_name is None and type_col in df.columns:
        # Several types may hold an id: the smallest is read, as in get().
        first = F.min_by(F.struct(F.lit(True).alias("_held"), *keep), F.coalesce(type_col, F.lit("")))
        docs = docs.groupBy(id_col).agg(first.alias("_doc")).select(id_col, *(F.col("_doc").getField(c).alias(c) for c in keep))
    found = asked.join(docs.select(id_col, *keep).withColumn("found", F.lit(True)), id_col, "left")
    found_now = F.coalesce("found", F.lit(False))
    return found.select(
        id_col, found_now.alias("found"), *keep, F.when(~found_now, F.lit("not found")).alias("error")
    )


def _literal_type(values: list) -> str:
    return "bigint" if values and all(isinstance(v, int) for v in values) else "string"


def count(df: DataFrame, type_name: str | None = None, type_col: str = "_type") -> DataFrame:
    """The number of documents, of one type if named."""
    return of_type(df, type_name, type_col).agg(F.count(F.lit(1)).alias("count"))


def hits_count(df: DataFrame, query: Clause | list | None, filter: Clause | list | None = None) -> DataFrame:
    """All documents that match, not only those on a page."""
    first = df.columns[0]
    # Sorting by a field means that no score is computed.
    found = search(df, first, query, filter, sort=[(first, "asc")], fields=[first])
    return found.summary.select("total")


def unlimited_search(df: DataFrame, id_col: str = "_id", **sections) -> DataFrame:
    """Every hit: id, score and the names that matched, in no order."""
    return search(df, id_col, size=None, fields=[id_col], **sections).hits


def pages(
    df: DataFrame, sort: list[tuple[str, str]], id_col: str = "_id", size: int = PAGE_SIZE
) -> DataFrame:
    """Rows with their ``page_no`` under ``sort`` and the id, both counted from 0.

    The rows are written once in order, which is also the snapshot that the pages are read from.
    """
    indexed = with_row_index(df, sort_columns(sort, id_col))
    return indexed.withColumn("page_no", F.floor(F.col("row_index") / size).cast("bigint"))


def iter_pages(paged: DataFrame) -> Iterator[list[Row]]:
    """The non-empty pages of :func:`pages` in order, one in memory at a time."""
    current, number = [], None
    for row in paged.orderBy("row_index").toLocalIterator():
        if number is not None and row["page_no"] != number:
            yield current
            current = []
        number = row["page_no"]
        current.append(row)
    if current:
        yield current


def write_pages(df: DataFrame, path: str, sort: list[tuple[str, str]], id_col: str = "_id", size: int = PAGE_SIZE) -> None:
    """Write sorted files of at most ``size`` rows each."""
    order = sort_columns(sort, id_col)
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.option("maxRecordsPerFile", size)
        .mode("errorifexists")
        .parquet(path)
    )


__all__ = [
    "DEFAULT_SIZE", "PAGE_SIZE", "count", "get", "hits_count", "iter_pages", "multi_get", "pages",
    "unlimited_search", "write_pages",
]
