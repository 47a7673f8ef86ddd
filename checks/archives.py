"""Jobs over archived JSON responses, which are made from the tables' own rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, words_sql
from quillspan.functions import json as qj
from quillspan.functions import text as ta
from quillspan.operators import responses
from quillspan.sources.readers import spread


def text(value):
    return F.col(value).cast("string")


@check(
    "q_classify",
    "SELECT event_id, CASE event_type WHEN 'view' THEN 'ok' WHEN 'error' THEN 'error' ELSE 'invalid' END AS outcome, "
    "CASE event_type WHEN 'error' THEN 'E' || event_id WHEN 'signup' THEN 'no payload' WHEN 'click' THEN "
    "'cannot map an empty payload' WHEN 'purchase' THEN 'cannot parse the payload' END AS error, "
    "CASE WHEN event_type = 'error' AND value < 50 THEN 500 END::INT AS status FROM events",
)
def classify(table):
    kind = F.col("event_type")
    failure = F.to_json(
        F.struct(F.concat(F.lit("E"), "event_id").alias("error"), F.when(F.col("value") < 50, 500).alias("status"))
    )
    payload = (
        F.when(kind == "view", F.col("props")).when(kind == "error", failure).when(kind == "click", "")
        .when(kind == "purchase", "Bad Json")
    )
    return responses.classify(spread(table("events")).select("event_id", payload.alias("payload"))).drop("payload")


@check(
    "q_classify_allow_error",
    "SELECT event_type, count(*) FILTER (WHERE event_type IN ('view', 'error')) AS ok, "
    "count(*) FILTER (WHERE event_type NOT IN ('view', 'error')) AS invalid FROM events GROUP BY 1",
)
def classify_allow_error(table):
    kind = F.col("event_type")
    payload = (
        F.when(kind == "view", F.col("props")).when(kind == "error", F.lit('{"error": "kept", "acknowledged": true}'))
        .when(kind == "click", " \n ").when(kind == "purchase", '{"k": ')
    )
    judged = responses.classify(table("events").select("event_type", payload.alias("payload")), allow_error=True)
    return judged.groupBy("event_type").agg(
        F.count_if(F.col("outcome") == "ok").alias("ok"), F.count_if(F.col("outcome") == "invalid").alias("invalid")
    )


def search_payload():
    hit = F.struct(
        F.when(F.col("lang") != "de", F.col("source")).alias("_index"),
        F.col("lang").alias("_type"),
        text("doc_id").alias("_id"),
        F.when(F.col("n_chars") > 100, F.col("n_chars") / 4.0).alias("_score"),
        F.struct("n_chars").alias("_source"),
        F.array(F.concat("source", F.lit("##9")), F.lit("plain")).alias("matched_queries"),
    )
    second = F.struct(
        F.lit(None).cast("string").alias("_index"),
        F.lit(None).cast("string").alias("_type"),
        F.concat(text("doc_id"), F.lit("b")).alias("_id"),
        F.lit(None).cast("double").alias("_score"),
        F.lit(None).cast("struct<n_chars:bigint>").alias("_source"),
        F.lit(None).cast("array<string>").alias("matched_queries"),
    )
    hits = F.when(F.col("lang") != "es", F.array(hit, second))
    return F.to_json(
        F.struct(
            F.col("n_chars").alias("took"),
            F.struct((F.col("doc_id") + 2).alias("total"), F.when(F.col("lang") != "fr", F.lit(1.5)).alias("max_score"), hits.alias("hits")).alias("hits"),
        )
    )


@check(
    "q_hits_extract",
    "SELECT doc_id, 0 AS pos, CASE WHEN lang <> 'de' THEN source END AS _index, lang AS _type, doc_id::VARCHAR AS _id, "
    "CASE WHEN n_chars > 100 THEN n_chars / 4.0::DOUBLE END AS _score, '{\"n_chars\":' || n_chars || '}' AS _source, "
    "source || ',plain' AS matched FROM documents WHERE lang <> 'es' UNION ALL "
    "SELECT doc_id, 1, NULL, NULL, doc_id || 'b', NULL, NULL, NULL FROM documents WHERE lang <> 'es'",
)
def hits_extract(table):
    archived = table("documents").select("doc_id", search_payload().alias("payload"))
    hits = responses.search_hits(archived)
    return hits.withColumn("matched", F.array_join("matched_queries", ",")).drop("matched_queries", "explanation")


@check(
    "q_search_totals",
    "SELECT doc_id, n_chars AS took, doc_id + 2 AS total, CASE WHEN lang <> 'fr' THEN 1.5::DOUBLE END AS max_score "
    "FROM documents",
)
def search_totals(table):
    archived = table("documents").select("doc_id", search_payload().alias("payload"))
    return responses.search_totals(archived).select("doc_id", "took", "total", "max_score")


@check(
    "q_get_responses",
    "SELECT doc_id, 'd' AS _index, doc_id::VARCHAR AS _id, toxic IS NOT NULL AS found, "
    "CASE WHEN toxic IS NOT NULL THEN 3::BIGINT END AS _version, "
    "CASE WHEN toxic IS NOT NULL THEN '{\"toxic\":' || toxic || '}' END AS _source "
    "FROM documents LEFT JOIN labels USING (doc_id)",
)
def get_responses(table):
    docs = table("documents").join(table("labels"), "doc_id", "left")
    found = F.col("toxic").isNotNull()
    payload = F.to_json(
        F.struct(
            F.lit("d").alias("_index"), text("doc_id").alias("_id"), F.when(found, 3).otherwise(0).alias("_version"),
            found.alias("found"), F.when(found, F.struct("toxic")).alias("_source"),
        )
    )
    rows = responses.get_responses(docs.select("doc_id", payload.alias("payload")))
    return rows.select("doc_id", "_index", "_id", "found", "_version", "_source")


@check(
    "q_multi_get_responses",
    "SELECT conv_id, turn, 0 AS pos, conv_id::VARCHAR AS _id, true AS found, (turn + 1)::BIGINT AS _version, "
    "'{\"role\":\"' || role || '\"}' AS _source, NULL::VARCHAR AS error FROM conversations UNION ALL "
    "SELECT conv_id, turn, 1, role, false, NULL, NULL, 'no shard ' || turn FROM conversations",
)
def multi_get_responses(table):
    there = F.struct(
        text("conv_id").alias("_id"), (F.col("turn") + 1).alias("_version"), F.lit(True).alias("found"),
        F.struct("role").alias("_source"), F.lit(None).cast("string").alias("error"),
    )
    gone = F.struct(
        F.col("role").alias("_id"), F.lit(0).cast("bigint").alias("_version"), F.lit(False).alias("found"),
        F.lit(None).cast("struct<role:string>").alias("_source"), F.concat(F.lit("no shard "), "turn").alias("error"),
    )
    payload = F.to_json(F.struct(F.array(there, gone).alias("docs")))
    rows = responses.multi_get_rows(table("conversations").select("conv_id", "turn", payload.alias("payload")))
    return rows.drop("_index", "_type")


@check(
    "q_delete_flatten",
    "SELECT p_partkey, p_brand AS index, p_size + 1 AS total, p_size AS successful, 1 AS failed FROM part",
)
def delete_flatten(table):
    shards = F.struct((F.col("p_size") + 1).alias("total"), F.col("p_size").alias("successful"), F.lit(1).alias("failed"))
    body = F.struct(F.create_map(F.col("p_brand"), F.struct(shards.alias("_shards"))).alias("_indices"))
    return responses.delete_rows(table("part").select("p_partkey", F.to_json(body).alias("payload")))


@check(
    "q_update_rows",
    "SELECT o_orderkey, 'o' AS _index, 't' AS _type, o_orderkey::VARCHAR AS _id, o_custkey AS _version, "
    "o_orderstatus = 'F' AS created FROM orders",
)
def update_rows(table):
    body = F.struct(
        F.lit("o").alias("_index"), F.lit("t").alias("_type"), text("o_orderkey").alias("_id"),
        F.col("o_custkey").alias("_version"), (F.col("o_orderstatus") == "F").alias("created"),
    )
    return responses.update_rows(table("orders").select("o_orderkey", F.to_json(body).alias("payload")))


@check(
    "q_bulk_items",
    "SELECT o_orderkey, 0 AS pos, 'update' AS kind, 'o' AS _index, 't' AS _type, o_custkey::VARCHAR AS _id, "
    "2::BIGINT AS _version, CASE WHEN o_orderstatus = 'F' THEN 429 ELSE 200 END AS status, "
    "CASE WHEN o_orderstatus = 'F' THEN 'busy' END AS error, NULL::BOOLEAN AS found FROM orders UNION ALL "
    "SELECT o_orderkey, 1, 'delete', 'o', 't', o_custkey::VARCHAR, 3, 404, NULL, o_orderstatus = 'P' FROM orders UNION ALL "
    "SELECT o_orderkey, 2, 'unknown', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM orders",
)
def bulk_items(table):
    status = F.col("o_orderstatus")
    key = [F.lit("o").alias("_index"), F.lit("t").alias("_type"), text("o_custkey").alias("_id")]
    update = F.struct(
        *key, F.lit(2).alias("_version"), F.when(status == "F", 429).otherwise(200).alias("status"),
        F.when(status == "F", "busy").alias("error"),
    )
    delete = F.struct(*key, F.lit(3).alias("_version"), F.lit(404).alias("status"), (status == "P").alias("found"))
    items = F.concat(
        F.lit('{"errors":"false","items":[{"update":'), F.to_json(update), F.lit('},{"delete":'), F.to_json(delete),
        F.lit('},{"create":{"status":201}}]}'),
    )
    return responses.bulk_items(spread(table("orders")).select("o_orderkey", items.alias("payload")))


# Returned lines answer with an error object, others with a list of two shards.
@check(
    "q_listing_shards",
    "SELECT l_orderkey, l_partkey, 'i' || l_suppkey AS index, l_linenumber::INT AS shard, 'STARTED' AS state, "
    "'n' || l_partkey AS node, 'p' AS prirep, CASE WHEN l_linestatus = 'O' THEN l_partkey * 10 END::BIGINT AS docs, "
    "l_orderkey * 7 AS store FROM lineitem WHERE l_returnflag <> 'R' UNION ALL "
    "SELECT l_orderkey, l_partkey, 'i' || l_suppkey, l_linenumber::INT + 1, 'UNASSIGNED', NULL, 'r', NULL, NULL "
    "FROM lineitem WHERE l_returnflag <> 'R'",
)
def listing_shards(table):
    index = F.concat(F.lit("i"), "l_suppkey")
    first = F.struct(
        index.alias("index"), text("l_linenumber").alias("shard"), F.lit("STARTED").alias("state"),
        F.concat(F.lit("n"), "l_partkey").alias("node"),
        F.when(F.col("l_linestatus") == "O", (F.col("l_partkey") * 10).cast("string")).alias("docs"),
        (F.col("l_orderkey") * 7).cast("string").alias("store"), F.lit("p").alias("prirep"),
    )
    second = F.struct(
        index.alias("index"), (F.col("l_linenumber") + 1).cast("string").alias("shard"), F.lit("UNASSIGNED").alias("state"),
        F.lit(None).cast("string").alias("node"), F.lit(None).cast("string").alias("docs"),
        F.lit(None).cast("string").alias("store"), F.lit("r").alias("prirep"),
    )
    payload = F.when(F.col("l_returnflag") == "R", F.lit('{"error": "none", "index": "x"}')).otherwise(
        F.to_json(F.array(first, second))
    )
    return responses.shard_listing(spread(table("lineitem")).select("l_orderkey", "l_partkey", payload.alias("payload")))


@check(
    "q_listing_nodes",
    "SELECT s_suppkey, s_name AS name, CASE WHEN s_acctbal > 0 THEN 'd' ELSE 'c' END AS node_role, "
    "s_acctbal > 0 AS is_data_node FROM supplier WHERE s_nationkey >= 5",
)
def listing_nodes(table):
    node = F.struct(F.col("s_name").alias("name"), F.when(F.col("s_acctbal") > 0, "d").otherwise("c").alias("node.role"))
    payload = F.when(F.col("s_nationkey") >= 5, F.to_json(F.array(node))).when(F.col("s_nationkey") > 0, "  ")
    return responses.node_listing(table("supplier").select("s_suppkey", payload.alias("payload")))


@check(
    "q_listing_indices",
    "SELECT p_partkey, 'green' AS health, 'open' AS status, p_name AS index, p_size::INT AS pri, 1 AS rep, "
    "p_partkey * 3 AS docs_count, NULL::BIGINT AS docs_deleted, p_size || 'kb' AS store_size, "
    "NULL::VARCHAR AS pri_store_size FROM part",
)
def listing_indices(table):
    record = F.struct(
        F.lit("green").alias("health"), F.lit("open").alias("status"), F.col("p_name").alias("index"),
        text("p_size").alias("pri"), F.lit("1").alias("rep"), (F.col("p_partkey") * 3).cast("string").alias("docs.count"),
        F.lit("").alias("docs.deleted"), F.concat("p_size", F.lit("kb")).alias("store.size"),
    )
    payload = F.to_json(F.array(record))
    return responses.index_listing(table("part").select("p_partkey", payload.alias("payload")))


@check(
    "q_node_stats",
    "SELECT 'n' || c_custkey AS node_id, c_name AS name, (c_custkey % 100)::INT AS heap_used_percent, "
    "c_custkey * 1000 AS heap_used_in_bytes, CASE WHEN c_acctbal >= 0 THEN 900000 + c_custkey END::BIGINT "
    "AS disk_total_in_bytes, c_custkey AS disk_available_in_bytes, "
    "CASE WHEN c_acctbal >= 0 THEN 900000 END::BIGINT AS disk_used_in_bytes, c_mktsegment AS attribute_zone, "
    "NULL::VARCHAR AS attribute_rack FROM customer",
)
def node_stats(table):
    node = F.struct(
        F.lit("h").alias("host"),
        F.col("c_name").alias("name"),
        F.struct(
            F.struct(
                (F.col("c_custkey") % 100).cast("int").alias("heap_used_percent"),
                (F.col("c_custkey") * 1000).alias("heap_used_in_bytes"),
            ).alias("mem")
        ).alias("jvm"),
        F.struct(
            F.struct(
                F.when(F.col("c_acctbal") >= 0, F.col("c_custkey") + 900000).alias("total_in_bytes"),
                F.col("c_custkey").alias("available_in_bytes"),
            ).alias("total")
        ).alias("fs"),
        F.struct(F.col("c_mktsegment").alias("zone")).alias("attributes"),
    )
    payload = F.to_json(F.struct(F.create_map(F.concat(F.lit("n"), "c_custkey"), node).alias("nodes")))
    rows = responses.node_stats(table("customer").select(payload.alias("payload")), attributes=("zone", "rack"))
    return rows.drop("host", "heap_max_in_bytes")


@check(
    "q_routing_explode",
    "SELECT o_orderkey, 'STARTED' AS state, true AS primary, 'n' || o_custkey AS node, 0 AS shard, "
    "'idx-' || o_orderstatus AS index, NULL AS unassigned_reason, NULL AS unassigned_at FROM orders UNION ALL "
    "SELECT o_orderkey, 'UNASSIGNED', false, NULL, 0, 'idx-' || o_orderstatus, o_orderpriority, "
    "CASE WHEN o_orderstatus <> 'F' THEN 'day' END FROM orders UNION ALL "
    "SELECT o_orderkey, 'STARTED', true, 'm', 1, 'idx-' || o_orderstatus, NULL, NULL FROM orders",
)
def routing_explode(table):
    index = F.concat(F.lit("idx-"), "o_orderstatus")
    none = F.lit(None).cast("string")
    no_info = F.lit(None).cast("struct<reason:string,at:string>")

    def copy(state, primary, node, shard, info):
        return F.struct(
            F.lit(state).alias("state"), F.lit(primary).alias("primary"), node.alias("node"),
            F.lit(shard).alias("shard"), index.alias("index"), info.alias("unassigned_info"),
        )

    info = F.struct(F.col("o_orderpriority").alias("reason"), F.when(F.col("o_orderstatus") != "F", "day").alias("at"))
    shards = F.create_map(
        F.lit("0"), F.array(copy("STARTED", True, F.concat(F.lit("n"), "o_custkey"), 0, no_info), copy("UNASSIGNED", False, none, 0, info)),
        F.lit("1"), F.array(copy("STARTED", True, F.lit("m"), 1, no_info)),
    )
    table_json = F.struct(F.struct(F.create_map(index, F.struct(shards.alias("shards"))).alias("indices")).alias("routing_table"))
    rows = responses.routing_shards(spread(table("orders")).select("o_orderkey", F.to_json(table_json).alias("payload")))
    return rows.select("o_orderkey", "state", "primary", "node", "shard", "index", "unassigned_reason", "unassigned_at")


# An order asks for its customer's health; customers of segment MACHINERY send none.
@check(
    "q_worst_status",
    "WITH h AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 2 WHEN c_acctbal < 500 THEN 1 ELSE 0 END AS rank "
    "FROM customer WHERE c_mktsegment <> 'MACHINERY') "
    "SELECT o_orderdate::DATE::VARCHAR AS day, ['green', 'yellow', 'red'][max(coalesce(rank, 2)) + 1] AS status, "
    "bool_or(rank IS NULL) AS timed_out FROM orders LEFT JOIN h ON c_custkey = o_custkey GROUP BY 1",
)
def worst_status(table):
    balance = F.col("c_acctbal")
    health = table("customer").where("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("index"),
        F.when(balance < 0, "red").when(balance < 500, "yellow").otherwise("green").alias("status"),
    )
    asked = table("orders").select(
        F.col("o_custkey").alias("index"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )
    return responses.worst_status(asked, health, ["day"])


@check(
    "q_alias_flatten",
    "SELECT doc_id, source AS index, lang AS alias, CASE WHEN n_chars > 500 THEN 'r' || n_chars END AS index_routing, "
    "NULL::VARCHAR AS search_routing FROM documents",
)
def alias_flatten(table):
    routing = F.struct(F.when(F.col("n_chars") > 500, F.concat(F.lit("r"), "n_chars")).alias("index_routing"))
    bare = F.struct(F.create_map().cast("map<string,struct<index_routing:string>>").alias("aliases"))
    body = F.create_map(
        F.col("source"), F.struct(F.create_map(F.col("lang"), routing).alias("aliases")), F.lit("empty"), bare
    )
    return responses.alias_rows(table("documents").select("doc_id", F.to_json(body).alias("payload")))


@check(
    "q_mapping_flatten",
    "SELECT p_partkey, 'parts' AS index, p_brand AS type, 'name' AS field, 'string' AS data_type FROM part UNION ALL "
    "SELECT p_partkey, 'parts', p_brand, p_name, 'long' FROM part",
)
def mapping_flatten(table):
    fields = F.create_map(
        F.lit("name"), F.struct(F.lit("string").alias("type"), F.lit("no").alias("index")),
        F.col("p_name"), F.struct(F.lit("long").alias("type"), F.lit("yes").alias("index")),
    )
    types = F.create_map(F.col("p_brand"), F.struct(fields.alias("properties")))
    body = F.create_map(F.lit("parts"), F.struct(types.alias("mappings")))
    return responses.mapping_rows(table("part").select("p_partkey", F.to_json(body).alias("payload")))


@check(
    "q_snapshot_flatten",
    "SELECT o_orderkey, 's' || o_orderkey AS snapshot, o_orderstatus || ',' || o_orderpriority AS indices, "
    "CASE WHEN o_totalprice > 100000 THEN 'SUCCESS' ELSE 'FAILED' END AS state FROM orders",
)
def snapshot_flatten(table):
    entry = F.struct(
        F.concat(F.lit("s"), "o_orderkey").alias("snapshot"), F.array("o_orderstatus", "o_orderpriority").alias("indices"),
        F.when(F.col("o_totalprice") > 100000, "SUCCESS").otherwise("FAILED").alias("state"),
    )
    payload = F.to_json(F.struct(F.array(entry).alias("snapshots")))
    rows = responses.snapshot_rows(spread(table("orders")).select("o_orderkey", payload.alias("payload")))
    return rows.withColumn("indices", F.array_join("indices", ","))


@check(
    "q_repository_flatten",
    "SELECT c_custkey, c_name AS name, 'fs' AS type, c_mktsegment AS location FROM customer",
)
def repository_flatten(table):
    body = F.create_map(
        F.col("c_name"),
        F.struct(F.lit("fs").alias("type"), F.create_map(F.lit("location"), F.col("c_mktsegment")).alias("settings")),
    )
    rows = responses.repository_rows(table("customer").select("c_custkey", F.to_json(body).alias("payload")))
    return rows.select("c_custkey", "name", "type", F.col("settings")["location"].alias("location"))


@check(
    "q_tokens_flatten",
    f"SELECT conv_id, turn, unnest(t) AS token, generate_subscripts(t, 1)::INT AS position FROM "
    f"(SELECT conv_id, turn, {words_sql()} AS t FROM conversations)",
)
def tokens_flatten(table):
    payload = F.to_json(F.struct(ta.analyze(F.col("text")).alias("tokens")))
    rows = responses.token_rows(table("conversations").select("conv_id", "turn", payload.alias("payload")))
    return rows.select("conv_id", "turn", "token", "position")


@check(
    "q_health_parse",
    "SELECT c_custkey, c_name AS cluster_name, 'green' AS status, c_acctbal < 0 AS timed_out, c_nationkey::INT AS "
    "number_of_nodes, NULL::INT AS number_of_data_nodes, 1 AS active_primary_shards, 2 AS active_shards, "
    "0 AS relocating_shards, 0 AS initializing_shards, 0 AS unassigned_shards FROM customer",
)
def health_parse(table):
    body = F.struct(
        F.col("c_name").alias("cluster_name"), F.lit("green").alias("status"), (F.col("c_acctbal") < 0).alias("timed_out"),
        F.col("c_nationkey").alias("number_of_nodes"), F.lit(1).alias("active_primary_shards"), F.lit(2).alias("active_shards"),
        F.lit(0).alias("relocating_shards"), F.lit(0).alias("initializing_shards"), F.lit(0).alias("unassigned_shards"),
        F.lit("ignored").alias("something_else"),
    )
    return responses.health_rows(table("customer").select("c_custkey", F.to_json(body).alias("payload")))


def two_spellings(table):
    """Every event's properties twice: as stored with a kind, and the other way round."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    one = F.concat(F.lit('{"k": '), k, F.lit(', "t": {"a": 1, "b": "'), kind, F.lit('"}}'))
    other = F.concat(F.lit('{"t":{"b":"'), kind, F.lit('","a":1},"k":'), k, F.lit("}"))
    decimal = F.concat(F.lit('{"t":{"b":"'), kind, F.lit('","a":1.0},"k":'), k, F.lit("}"))
    events = spread(table("events"))
    return (
        events.select("event_id", one.alias("doc"))
        .unionByName(events.select("event_id", other.alias("doc")))
        .unionByName(events.select("event_id", decimal.alias("doc")))
    )


PROPS = "SELECT event_id, event_type, regexp_extract(props, '[0-9]+') AS k FROM events"


@check(
    "q_json_dedup",
    "WITH p AS (" + PROPS + "), s AS (SELECT DISTINCT event_type, k FROM p) SELECT '{\"k\":' || k || ',\"t\":{\"a\":' || a "
    "|| ',\"b\":\"' || event_type || '\"}}' AS doc FROM s, (VALUES ('1'), ('1.0')) v(a)",
)
def json_dedup(table):
    # Equal texts are read once; they are counted, since Spark drops a distinct that is below another one.
    spellings = two_spellings(table).groupBy("doc").agg(F.count(F.lit(1)).alias("docs")).where("docs > 0")
    return spellings.select(qj.canonical_json(F.col("doc")).alias("doc")).distinct()


@check(
    "q_json_hash_groups",
    f"WITH p AS ({PROPS}) SELECT min(event_id) AS first, (count(*) * n)::BIGINT AS docs FROM p, (VALUES (1), (2)) v(n) "
    "GROUP BY event_type, k, n",
)
def json_hash_groups(table):
    spellings = two_spellings(table).groupBy("doc").agg(F.min("event_id").alias("first"), F.count(F.lit(1)).alias("docs"))
    hashed = spellings.select("first", "docs", qj.json_hash(F.lit("i"), document=F.col("doc")).alias("h"))
    return hashed.groupBy("h").agg(F.min("first").alias("first"), F.sum("docs").alias("docs")).drop("h")


ORDER_SCHEMA = "orderKey bigint, custKey bigint, orderStatus string, priceInfo struct<totalPrice: double, isLarge: boolean>"


@check(
    "q_to_json",
    "SELECT o_orderkey, '{\"order_key\":' || o_orderkey || ',\"cust_key\":' || o_custkey || ',\"order_status\":\"' || "
    "o_orderstatus || '\",\"price_info\":{\"is_large\":' || (o_totalprice > 100000) || '}}' AS doc FROM orders",
)
def to_json(table):
    schema = "orderKey bigint, custKey bigint, orderStatus string, priceInfo struct<isLarge: boolean>"
    record = F.struct(
        F.col("o_orderkey").alias("orderKey"), F.col("o_custkey").alias("custKey"), F.col("o_orderstatus").alias("orderStatus"),
        F.struct((F.col("o_totalprice") > 100000).alias("isLarge")).alias("priceInfo"),
    )
    return spread(table("orders")).select("o_orderkey", qj.to_snake_json(record, schema).alias("doc"))


@check(
    "q_from_json",
    "SELECT o_orderkey AS orderKey, o_custkey AS custKey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END "
    "AS orderStatus, o_totalprice AS totalPrice, o_totalprice > 100000 AS isLarge FROM orders",
)
def from_json(table):
    payload = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("cust_key"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("order_status"),
            F.struct(F.col("o_totalprice").alias("total_price"), (F.col("o_totalprice") > 100000).alias("is_large")).alias("price_info"),
            F.lit("x").alias("not_in_schema"),
        )
    )
    typed = spread(table("orders")).select(qj.from_snake_json(payload, ORDER_SCHEMA).alias("o"))
    return typed.select("o.orderKey", "o.custKey", "o.orderStatus", "o.priceInfo.totalPrice", "o.priceInfo.isLarge")
