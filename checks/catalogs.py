"""Aliases, mappings and index statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

import quillspan as q  # noqa: F401
from checks.registry import check
from quillspan.operators import catalog
from quillspan.sources.readers import as_documents

# Every source is an index; the languages found in it are its aliases.
ALIASES = "al AS (SELECT DISTINCT source AS index, lang AS alias FROM documents)"


def aliases(table):
    pairs = table("documents").select(F.col("source").alias("index"), F.col("lang").alias("alias")).distinct()
    none = F.lit(None).cast("string")
    return pairs.select("index", "alias", none.alias("index_routing"), none.alias("search_routing"))


@check(
    "q_alias_list",
    f"WITH {ALIASES} SELECT index, alias, NULL::VARCHAR AS index_routing, NULL::VARCHAR AS search_routing FROM al "
    "WHERE alias IN ('fr', 'de')",
)
def alias_list(table):
    return catalog.list_aliases(aliases(table), names=["fr", "de"])


@check(
    "q_alias_by_index",
    "SELECT s.source AS index, coalesce(string_agg(DISTINCT d.lang, ',' ORDER BY d.lang), '') AS aliases "
    "FROM (SELECT DISTINCT source FROM documents) s LEFT JOIN documents d ON d.source = s.source AND d.lang <> 'en' "
    "GROUP BY s.source",
)
def alias_by_index(table):
    indices = table("documents").select(F.col("source").alias("index"))
    foreign = aliases(table).where("alias <> 'en'")
    by_index = catalog.aliases_by_index(indices, foreign)
    return by_index.select("index", F.array_join("aliases", ",").alias("aliases"))


@check(
    "q_alias_modify",
    f"WITH {ALIASES}, added AS (SELECT DISTINCT source AS index, 'all' AS alias, 'r' AS routing FROM documents "
    "UNION ALL SELECT index, alias, 'new' FROM al WHERE alias = 'en'), "
    "m AS (SELECT index, alias, NULL AS routing FROM al ANTI JOIN added USING (index, alias) UNION ALL SELECT * FROM added) "
    "SELECT index, alias, routing AS index_routing, NULL::VARCHAR AS search_routing FROM m WHERE alias <> 'fr'",
)
def alias_modify(table):
    now = aliases(table)
    everything = now.select("index").distinct().select(
        "index", F.lit("all").alias("alias"), F.lit("r").alias("index_routing"), F.lit(None).cast("string").alias("search_routing")
    )
    renewed = now.where("alias = 'en'").withColumn("index_routing", F.lit("new"))
    return catalog.modify_aliases(now, everything.unionByName(renewed), now.where("alias = 'fr'"))


@check(
    "q_alias_union",
    "SELECT 'benchmark' AS _index, item_id, NULL::BIGINT AS conv_id, text FROM benchmark UNION ALL "
    "SELECT 'conversations', NULL, conv_id, text FROM conversations",
)
def alias_union(table):
    rows = [("benchmark", "prose", None, None), ("conversations", "prose", None, None), ("documents", "crawl", None, None)]
    known = table.spark.createDataFrame(rows, catalog.ALIAS_SCHEMA)
    tables = {
        "benchmark": table("benchmark").select("item_id", "text"),
        "conversations": table("conversations").select("conv_id", "text"),
        "documents": table("documents").select("doc_id", "text"),
    }
    return catalog.read_alias(known, "prose", tables)


@check(
    "q_alias_routing",
    "WITH r AS (SELECT source, min(lang) AS lang FROM documents GROUP BY 1) SELECT doc_id, d.source, d.lang "
    "FROM documents d JOIN r ON r.source = d.source WHERE d.lang = r.lang OR d.source IN ('src1', 'src2')",
)
def alias_routing(table):
    docs = table("documents").select("doc_id", "source", "lang")
    rows = docs.groupBy(F.col("source").alias("index")).agg(F.min("lang").alias("search_routing"))
    routing = F.when(~F.col("index").isin("src1", "src2"), F.col("search_routing"))
    known = rows.select("index", F.lit("main").alias("alias"), routing.alias("search_routing"))
    return catalog.through_alias(docs, known, "main", "source", routing_col="lang")


@check(
    "q_mappings",
    "SELECT event_type AS _index, 'event' AS _type, unnest(['k', 'label', 'nested']) AS field, "
    "unnest(['BIGINT', 'STRING', 'OBJECT<flag: BOOLEAN>']) AS data_type FROM events GROUP BY 1",
)
def json_mappings(table):
    source = F.to_json(
        F.struct(
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            F.col("event_type").alias("label"),
            F.struct((F.col("value") > 0).alias("flag")).alias("nested"),
        )
    )
    docs = table("events").select(F.col("event_type").alias("_index"), F.lit("event").alias("_type"), source.alias("_source"))
    return catalog.json_mappings(docs)


@check(
    "q_index_stats",
    "SELECT source AS _index, count(*) FILTER (WHERE coalesce(toxic, 0) <> 1) AS docs_count, "
    "count(*) FILTER (WHERE toxic = 1) AS docs_deleted, "
    "coalesce(sum(strlen(text)) FILTER (WHERE coalesce(toxic, 0) <> 1), 0)::BIGINT AS store_size "
    "FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
)
def index_stats(table):
    docs = table("documents").join(table("labels"), "doc_id", "left").withColumnRenamed("source", "_index")
    return catalog.index_stats(docs, "text", deleted=F.col("toxic") == 1)


@check(
    "q_documents",
    "SELECT 'parts' AS _index, p_brand AS _type, p_partkey::VARCHAR AS _id, 1::BIGINT AS _version, "
    "'{\"p_name\":\"' || p_name || '\",\"p_size\":' || p_size || '}' AS _source FROM part",
)
def documents(table):
    return as_documents(table("part"), "p_partkey", "parts", F.col("p_brand"), ["p_name", "p_size"])
