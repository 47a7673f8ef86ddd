"""Aliases, mappings and statistics of indices kept as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.functions.rows import unnest

ALIAS_SCHEMA = "index string, alias string, index_routing string, search_routing string"
_ALIAS = ["index", "alias"]
_ROUTINGS = ["index_routing", "search_routing"]


def modify_aliases(aliases: DataFrame, to_add: DataFrame | None = None, to_remove: DataFrame | None = None) -> DataFrame:
    """The alias table after all additions, then all removals; an added alias takes its new routing."""
    out = aliases.select(*_ALIAS, *_ROUTINGS)
    if to_add is not None:
        both = out.withColumn("_new", F.lit(0)).unionByName(
            to_add.select(*_ALIAS, *_ROUTINGS).withColumn("_new", F.lit(1))
        )
        out = (
            both.groupBy(*_ALIAS)
            .agg(F.max_by(F.struct(*_ROUTINGS), F.struct("_new", *_ROUTINGS)).alias("_r"))
            .select(*_ALIAS, "_r.*")
        )
    if to_remove is not None:
        out = out.join(to_remove.select(*_ALIAS).distinct(), _ALIAS, "left_anti")
    return out


def list_aliases(aliases: DataFrame, index: str | None = None, names: list[str] | None = None) -> DataFrame:
    """The aliases, all or those of one index or with certain names."""
    out = aliases
    if index is not None:
        out = out.where(F.col("index") == index)
    if names is not None:
        out = out.where(F.col("alias").isin(names))
    return out.select(*_ALIAS, *_ROUTINGS)


def aliases_by_index(indices: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row per index with the sorted array of its aliases, empty if it has none.

    An array has as many entries as an index has aliases; the alias table is a catalog, not data.
    """
    lists = aliases.groupBy("index").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
    return (
        indices.select("index")
        .distinct()
        .join(lists, "index", "left")
        .withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    )


def read_alias(aliases: DataFrame, alias: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The union of the indices behind an alias, each a table of its own, with ``_index``.

    Only alias rows come to the driver, which has to know the tables to read.
    """
    wanted = sorted(r["index"] for r in aliases.where(F.col("alias") == alias).select("index").distinct().collect())
    if not wanted:
        raise ValueError(f"no index has alias {alias!r}")
    parts = [tables[i].select(F.lit(i).alias("_index"), "*") for i in wanted]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def through_alias(
    docs: DataFrame, aliases: DataFrame, alias: str, index_col: str = "_index", routing_col: str | None = None
) -> DataFrame:
    """The documents behind an alias in one table that holds many indices.

    With ``routing_col`` an alias row that has a search routing only lets documents of that
    routing through.  On a table partitioned by index Spark prunes the other partitions.
    """
    rows = aliases.where(F.col("alias") == alias)
    if routing_col is None:
        wanted = rows.select(F.col("index").alias(index_col)).distinct()
        return docs.join(wanted, index_col, "left_semi")
    routed = rows.where(F.col("search_routing").isNotNull()).select(
        F.col("index").alias(index_col), F.col("search_routing").alias(routing_col)
    )
    # An index that also has an unrouted row of this alias is open as a whole.
    whole = rows.where(F.col("search_routing").isNull()).select(F.col("index").alias(index_col)).distinct()
    by_routing = docs.join(routed.distinct(), [index_col, routing_col], "left_semi")
    return docs.join(whole, index_col, "left_semi").unionByName(by_routing.join(whole, index_col, "left_anti"))


def mappings(tables: dict[str, DataFrame], indices: list[str] | None = None, type_name: str = "_doc") -> DataFrame:
    """Rows ``index, type, field, data_type`` of typed tables; unknown indices give no rows."""
    names = list(tables) if indices is None else [i for i in dict.fromkeys(indices) if i in tables]
    rows = [
        (i, type_name, path, data_type) for i in names for path, data_type in _fields(tables[i].schema)
    ]
    spark = next(iter(tables.values())).sparkSession if tables else SparkSession.active()
    return spark.createDataFrame(rows, "index string, type string, field string, data_type string")


def _fields(schema: T.StructType, above: str = ""):
    for f in schema:
        path = f"{above}{f.name}"
        if isinstance(f.dataType, T.StructType):
            yield from _fields(f.dataType, f"{path}.")
        else:
            yield path, f.dataType.simpleString()


def json_mappings(docs: DataFrame, source_col: str = "_source", by: tuple = ("_index", "_type")) -> DataFrame:
    """Rows ``<by>, field, data_type`` of the top-level fields found in JSON documents.

    Values of one field are merged into their common type while scanning; only one row per
    field is shuffled.
    """
    parsed = docs.select(*by, F.from_json(source_col, "map<string,variant>").alias("_m"))
    fields = unnest(parsed, "_m", "field", "value")
    return fields.groupBy(*by, "field").agg(F.schema_of_variant_agg("value").alias("data_type"))


def index_stats(docs: DataFrame, source_col: str = "_source", index_col: str = "_index", deleted=None) -> DataFrame:
    """Documents, deleted documents and bytes per index; ``deleted`` tells removed documents apart."""
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    size = F.octet_length(source_col).cast("bigint")
    return docs.groupBy(index_col).agg(
        F.count_if(~gone).alias("docs_count"),
        F.count_if(gone).alias("docs_deleted"),
        F.coalesce(F.sum(F.when(~gone, size)), F.lit(0)).cast("bigint").alias("store_size"),
    )
