"""Typed rows from archived JSON API responses, one response per row in a ``payload`` column.

Every job is a projection of its input: it keeps the key columns it is given, parses with a
fixed schema inside the scan's stage and explodes without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan.functions.json import is_json
from quillspan.functions.rows import unnest
from quillspan.operators.clauses import NAME_DELIMITER

# Record layouts of the responses.
HIT = (
    "_index string, _type string, _id string, _score double, _source string, "
    "matched_queries array<string>, _explanation string"
)
SEARCH_RESPONSE = (
    f"took bigint, hits struct<total: bigint, max_score: double, hits: array<struct<{HIT}>>>, "
    "aggregations string, _scroll_id string"
)
GET_RESPONSE = "_index string, _type string, _id string, _version bigint, found boolean, _source string, error string"
UPDATE_RESPONSE = "_index string, _type string, _id string, _version bigint, created boolean"
DELETE_RESPONSE = "_indices map<string, struct<_shards: struct<total: int, successful: int, failed: int>>>"
BULK_ITEM = "_index string, _type string, _id string, _version bigint, status int, error string"
BULK_RESPONSE = (
    f"errors string, items array<struct<update: struct<{BULK_ITEM}>, "
    f"delete: struct<{BULK_ITEM}, found: boolean>>>"
)
SHARD_LISTING = "index string, shard string, state string, node string, docs string, store string, prirep string"
NODE_LISTING = "name string, `node.role` string"
INDEX_LISTING = (
    "health string, status string, index string, pri string, rep string, `docs.count` string, "
    "`docs.deleted` string, `store.size` string, `pri.store.size` string"
)
NODE_STATS = (
    "nodes map<string, struct<host: string, name: string, "
    "jvm: struct<mem: struct<heap_used_percent: int, heap_used_in_bytes: bigint, heap_max_in_bytes: bigint>>, "
    "fs: struct<total: struct<total_in_bytes: bigint, available_in_bytes: bigint>>, "
    "attributes: map<string, string>>>"
)
SHARD_COPY = (
    "state string, primary boolean, node string, relocating_node string, shard int, index string, "
    "unassigned_info struct<reason: string, at: string, details: string>"
)
ROUTING_TABLE = (
    f"routing_table struct<indices: map<string, struct<shards: map<string, array<struct<{SHARD_COPY}>>>>>>"
)
ALIASES = "map<string, struct<aliases: map<string, struct<index_routing: string, search_routing: string>>>>"
MAPPINGS = "map<string, struct<mappings: map<string, struct<properties: map<string, struct<type: string>>>>>>"
SNAPSHOTS = "snapshots array<struct<snapshot: string, indices: array<string>, state: string>>"
REPOSITORIES = "map<string, struct<type: string, settings: map<string, string>>>"
TOKENS = "tokens array<struct<token: string, start_offset: int, end_offset: int, type: string, position: int>>"
HEALTH = (
    "cluster_name string, status string, timed_out boolean, number_of_nodes int, number_of_data_nodes int, "
    "active_primary_shards int, active_shards int, relocating_shards int, initializing_shards int, "
    "unassigned_shards int"
)
DATA_NODE_ROLE = "d"
SEVERITY = {"green": 0, "yellow": 1, "red": 2}


def _keys(df: DataFrame, payload: str) -> list[str]:
    return [c for c in df.columns if c != payload]


def classify(df: DataFrame, payload: str = "payload", allow_error: bool = False) -> DataFrame:
    """Add ``outcome`` (ok, error or invalid), ``error`` and ``status``.

    An absent payload is invalid; an object with an ``error`` key is an error unless errors are
    allowed; blank text cannot be mapped and other text cannot be parsed, both invalid.
    """
    text = F.col(payload)
    # Listing the keys of an object also proves that it is one; only other text is read again.
    tested = df.withColumn("_keys", F.json_object_keys(text)).withColumns(
        {
            "_absent": text.isNull(),
            "_failed": F.lit(False) if allow_error else F.coalesce(F.array_contains("_keys", "error"), F.lit(False)),
            "_blank": text.rlike(r"^\s*$"),
            "_broken": F.col("_keys").isNull() & ~is_json(text),
        }
    )
    absent, failed, blank, broken = (F.col(c) for c in ("_absent", "_failed", "_blank", "_broken"))
    outcome = F.when(absent, "invalid").when(failed, "error").when(blank | broken, "invalid").otherwise("ok")
    message = (
        F.when(absent, "no payload")
        .when(failed, F.get_json_object(text, "$.error"))
        .when(blank, "cannot map an empty payload")
        .when(broken, "cannot parse the payload")
    )
    status = F.when(failed, F.get_json_object(text, "$.status").try_cast("int"))
    judged = tested.withColumns({"outcome": outcome, "error": message, "status": status})
    return judged.drop("_keys", "_absent", "_failed", "_blank", "_broken")


def matched_names(names: Column) -> Column:
    """Names of matched clauses without the delimiter and what follows it."""
    return F.transform(names, lambda n: F.substring_index(n, NAME_DELIMITER, 1))


def search_totals(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Per response: ``took, total, max_score, aggregations, scroll_id``."""
    return df.select(*_keys(df, payload), F.from_json(payload, SEARCH_RESPONSE).alias("_r")).select(
        *_keys(df, payload),
        F.col("_r.took").alias("took"),
        F.col("_r.hits.total").alias("total"),
        F.col("_r.hits.max_score").alias("max_score"),
        F.col("_r.aggregations").alias("aggregations"),
        F.col("_r._scroll_id").alias("scroll_id"),
    )


def search_hits(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per hit with its ``pos``; a response without hits gives none."""
    keys = _keys(df, payload)
    parsed = df.select(*keys, F.from_json(payload, SEARCH_RESPONSE).alias("_r"))
    return unnest(parsed, "_r.hits.hits", "_h", position="pos").select(
        *keys,
        "pos",
        *[F.col(f"_h.{c}").alias(c) for c in ("_index", "_type", "_id", "_score", "_source")],
        matched_names(F.col("_h.matched_queries")).alias("matched_queries"),
        F.col("_h._explanation").alias("explanation"),
    )


def pages_from_responses(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Result pages in the shape that page folding reads, failures included."""
    keys = _keys(df, payload)
    judged = classify(df, payload).withColumn("_r", F.from_json(payload, SEARCH_RESPONSE))
    return judged.select(
        *keys,
        *[F.col(f"_r.{c}").alias(c) for c in ("took", "aggregations")],
        F.col("_r.hits.total").alias("total"),
        F.col("_r.hits.max_score").alias("max_score"),
        F.col("_r.hits.hits").alias("hits"),
        F.when(F.col("outcome") != "ok", F.coalesce("error", F.lit(""))).alias("error"),
        "status",
    )


def get_responses(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A fetched document; a missing one has neither version nor source."""
    keys = _keys(df, payload)
    return _fetched(df.select(*keys, F.from_json(payload, GET_RESPONSE).alias("_r")), keys, "_r")


def _fetched(df: DataFrame, keys: list[str], record: str) -> DataFrame:
    found = F.coalesce(F.col(f"{record}.found"), F.lit(False))
    return df.select(
        *keys,
        *[F.col(f"{record}.{c}").alias(c) for c in ("_index", "_type", "_id")],
        found.alias("found"),
        F.when(found, F.col(f"{record}._version")).alias("_version"),
        F.when(found, F.col(f"{record}._source")).alias("_source"),
        F.col(f"{record}.error").alias("error"),
    )


def multi_get_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per document of a multi-get response, in the same shape."""
    keys = _keys(df, payload)
    parsed = df.select(*keys, F.from_json(payload, f"docs array<struct<{GET_RESPONSE}>>").alias("_r"))
    return _fetched(unnest(parsed, "_r.docs", "_d", position="pos"), [*keys, "pos"], "_d")


def delete_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows ``index, total, successful, failed`` of a delete-by-query response."""
    keys = _keys(df, payload)
    parsed = df.select(*keys, F.from_json(payload, DELETE_RESPONSE).alias("_r"))
    return unnest(parsed, "_r._indices", "index", "_d").select(*keys, "index", "_d._shards.*")


def update_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The written document of a single-document write, with ``created``."""
    keys = _keys(df, payload)
    return df.select(*keys, F.from_json(payload, UPDATE_RESPONSE).alias("_r")).select(*keys, "_r.*")


def bulk_items(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per item of a write response, with its place ``pos`` and its ``kind``.

    An item that is neither an update nor a delete has kind ``unknown`` and no further values.
    """
    keys = _keys(df, payload)
    parsed = df.select(*keys, F.from_json(payload, BULK_RESPONSE).alias("_r"))
    items = unnest(parsed, "_r.items", "_i", position="pos")
    either = [
        F.coalesce(F.col(f"_i.update.{c}"), F.col(f"_i.delete.{c}")).alias(c)
        for c in ("_index", "_type", "_id", "_version", "status", "error")
    ]
    kind = F.when(F.col("_i.update").isNotNull(), "update").when(F.col("_i.delete").isNotNull(), "delete")
    return items.select(
        *keys, "pos", F.coalesce(kind, F.lit("unknown")).alias("kind"), *either, F.col("_i.delete.found").alias("found")
    )


def _listing(df: DataFrame, payload: str, record: str) -> DataFrame:
    """Rows of a listing that is a JSON array; objects (errors) and blanks give none."""
    is_list = F.ltrim(F.col(payload)).startswith("[")
    rows = F.when(is_list, F.from_json(payload, f"array<struct<{record}>>"))
    return unnest(df.select(*_keys(df, payload), rows.alias("_r")), "_r", "_e")


def shard_listing(df: DataFrame, payload: str = "payload") -> DataFrame:
    listed = _listing(df, payload, SHARD_LISTING)
    return listed.select(
        *_keys(df, payload),
        F.col("_e.index").alias("index"),
        F.col("_e.shard").try_cast("int").alias("shard"),
        *[F.col(f"_e.{c}").alias(c) for c in ("state", "node", "prirep")],
        F.col("_e.docs").try_cast("bigint").alias("docs"),
        F.col("_e.store").try_cast("bigint").alias("store"),
    )


def node_listing(df: DataFrame, payload: str = "payload") -> DataFrame:
    role = F.col("_e")["node.role"]
    return _listing(df, payload, NODE_LISTING).select(
        *_keys(df, payload),
        F.col("_e.name").alias("name"),
        role.alias("node_role"),
        F.coalesce(role == DATA_NODE_ROLE, F.lit(False)).alias("is_data_node"),
    )


def index_listing(df: DataFrame, payload: str = "payload") -> DataFrame:
    return _listing(df, payload, INDEX_LISTING).select(
        *_keys(df, payload),
        *[F.col(f"_e.{c}").alias(c) for c in ("health", "status", "index")],
        F.col("_e.pri").try_cast("int").alias("pri"),
        F.col("_e.rep").try_cast("int").alias("rep"),
        F.col("_e")["docs.count"].try_cast("bigint").alias("docs_count"),
        F.col("_e")["docs.deleted"].try_cast("bigint").alias("docs_deleted"),
        F.col("_e")["store.size"].alias("store_size"),
        F.col("_e")["pri.store.size"].alias("pri_store_size"),
    )


def node_stats(df: DataFrame, payload: str = "payload", attributes: tuple = ()) -> DataFrame:
    """One row per node; used disk is NULL unless both sizes are known."""
    keys = _keys(df, payload)
    parsed = df.select(*keys, F.from_json(payload, NODE_STATS).alias("_r"))
    nodes = unnest(parsed, "_r.nodes", "node_id", "_n")
    total, free = F.col("_n.fs.total.total_in_bytes"), F.col("_n.fs.total.available_in_bytes")
    return nodes.select(
        *keys,
        "node_id",
        F.col("_n.host").alias("host"),
        F.col("_n.name").alias("name"),
        *[F.col(f"_n.jvm.mem.{c}").alias(c) for c in ("heap_used_percent", "heap_used_in_bytes", "heap_max_in_bytes")],
        total.alias("disk_total_in_bytes"),
        free.alias("disk_available_in_bytes"),
        (total - free).alias("disk_used_in_bytes"),
        *[F.try_element_at(F.col("_n.attributes"), F.lit(a)).alias(f"attribute_{a}") for a in attributes],
    )


def routing_shards(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per copy of a shard from a routing table of indices, shards and copies."""
    keys = _keys(df, payload)
    parsed = df.select(*keys, F.from_json(payload, ROUTING_TABLE).alias("_r"))
    shards = unnest(unnest(parsed, "_r.routing_table.indices", "_name", "_i"), "_i.shards", "_number", "_c")
    return unnest(shards, "_c", "_s").select(
        *keys,
        *[F.col(f"_s.{c}").alias(c) for c in ("state", "primary", "node", "relocating_node", "shard", "index")],
        F.col("_s.unassigned_info.reason").alias("unassigned_reason"),
        F.col("_s.unassigned_info.at").alias("unassigned_at"),
        F.col("_s.unassigned_info.details").alias("unassigned_details"),
    )


def worst_status(requested: DataFrame, health: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``status, timed_out`` of the least healthy of the requested indices (column ``index``).

    A requested index without a health row ``index, status`` counts as red and timed out.
    ``by`` names columns of ``requested`` that tell requests apart.
    """
    severity = F.lit(None).cast("int")
    for label, rank in SEVERITY.items():
        severity = F.when(F.col("status") == label, F.lit(rank)).otherwise(severity)
    worst = max(SEVERITY.values())
    ranked = health.groupBy("index").agg(F.max(severity).alias("_rank"))
    joined = requested.join(ranked, "index", "left")
    out = joined.groupBy(*(by or [])).agg(
        F.max(F.coalesce("_rank", F.lit(worst))).alias("_rank"),
        F.coalesce(F.bool_or(F.col("_rank").isNull()), F.lit(False)).alias("timed_out"),
    )
    label = F.lit(None).cast("string")
    for name, rank in SEVERITY.items():
        label = F.when(F.col("_rank") == rank, F.lit(name)).otherwise(label)
    return out.select(*(by or []), label.alias("status"), "timed_out")


def alias_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows ``index, alias, index_routing, search_routing``; an index without aliases gives none."""
    keys = _keys(df, payload)
    indices = unnest(df.select(*keys, F.from_json(payload, ALIASES).alias("_p")), "_p", "index", "_a")
    return unnest(indices, "_a.aliases", "alias", "_r").select(
        *keys, "index", "alias", "_r.index_routing", "_r.search_routing"
    )


def mapping_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows ``index, type, field, data_type``."""
    keys = _keys(df, payload)
    indices = unnest(df.select(*keys, F.from_json(payload, MAPPINGS).alias("_r")), "_r", "index", "_m")
    types = unnest(indices, "_m.mappings", "type", "_t")
    return unnest(types, "_t.properties", "field", "_p").select(
        *keys, "index", "type", "field", F.col("_p.type").alias("data_type")
    )


def snapshot_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows ``snapshot, indices, state``."""
    keys = _keys(df, payload)
    parsed = df.select(*keys, F.from_json(payload, SNAPSHOTS).alias("_r"))
    return unnest(parsed, "_r.snapshots", "_s").select(*keys, "_s.*")


def repository_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows ``name, type, settings``."""
    keys = _keys(df, payload)
    parsed = df.select(*keys, F.from_json(payload, REPOSITORIES).alias("_r"))
    return unnest(parsed, "_r", "name", "_d").select(*keys, "name", "_d.type", "_d.settings")


def token_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per token of an analysis response."""
    keys = _keys(df, payload)
    parsed = df.select(*keys, F.from_json(payload, TOKENS).alias("_r"))
    return unnest(parsed, "_r.tokens", "_t").select(*keys, "_t.*")


def health_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The ten fields of a health record; others are ignored."""
    keys = _keys(df, payload)
    return df.select(*keys, F.from_json(payload, HEALTH).alias("_r")).select(*keys, "_r.*")
