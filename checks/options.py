"""Options of clauses and aggregations, documents kept as JSON, and corners of reading and writing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import quillspan as q
from checks.registry import any_sql, check, weight_sql
from checks.relevance import TWO, scored, scored_sql, texts
from checks.writing import as_actions, customers
from quillspan.operators import catalog
from quillspan.plans.durable import new_folder
from quillspan.sources.readers import as_documents
from quillspan.sources.store import SnapshotRepository, Store


def parts(table):
    return as_documents(table("part"), "p_partkey", "parts", F.col("p_brand"), ["p_name", "p_size", "p_retailprice"])


@check("q_from_unsorted", "SELECT event_id, 1.0::DOUBLE AS score FROM events ORDER BY event_id OFFSET 990")
def from_unsorted(table):
    return q.search(table("events"), "event_id", size=None, from_=990, fields=["event_id"]).hits


@check(
    "q_multi_get_types",
    "SELECT o_custkey AS _id, min(l_returnflag) IS NOT NULL AS found, min(l_returnflag) AS _type, "
    "CASE WHEN min(l_returnflag) IS NULL THEN 'not found' END AS error "
    "FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN lineitem ON l_orderkey = o_custkey GROUP BY 1",
)
def multi_get_types(table):
    lines = table("lineitem").select(F.col("l_orderkey").alias("_id"), F.col("l_returnflag").alias("_type"))
    return q.multi_get(lines, table("orders").select("o_custkey"), "_id")


@check(
    "q_search_json",
    "SELECT p_partkey::VARCHAR AS _id, p_name, 3.0::DOUBLE AS score FROM part WHERE p_size >= 10 AND p_size < 30 "
    "AND p_retailprice > 950",
)
def search_json(table):
    return q.search(
        parts(table),
        "_id",
        query=q.bool_(must=q.range_("p_size", ("gte", 10), ("lt", 30)), boost=3.0),
        filter=q.range_("p_retailprice", ("gt", 950.0)),
        size=None,
        fields=["_id", "p_name"],
    ).hits


@check(
    "q_search_mapped",
    "SELECT p_partkey::VARCHAR AS _id, p_size::INT AS p_size, NULL::DOUBLE AS score FROM part WHERE p_size <> 7 "
    "ORDER BY part.p_size DESC, p_partkey::VARCHAR LIMIT 50",
)
def search_mapped(table):
    typed = q.mapped(parts(table), "p_size int, p_name string")
    found = q.search(
        typed, "_id", filter=q.bool_(must_not=q.term("p_size", 7)), sort=[("p_size", "desc")], size=50, fields=["_id", "p_size"]
    )
    return found.hits


@check(
    "q_multi_get_source_field",
    "SELECT i.id::VARCHAR AS _id, p_partkey IS NOT NULL AS found, p_name, "
    "CASE WHEN p_partkey IS NULL THEN 'not found' END AS error "
    "FROM (SELECT DISTINCT l_suppkey * 3 AS id FROM lineitem) i LEFT JOIN part ON p_partkey = i.id",
)
def multi_get_source_field(table):
    asked = table("lineitem").select((F.col("l_suppkey") * 3).alias("id"))
    return q.multi_get(parts(table), asked, "_id", fields=["p_name"])


@check(
    "q_agg_json",
    "SELECT p_size::VARCHAR AS key, count(*) AS doc_count FROM part GROUP BY 1 ORDER BY doc_count DESC, key LIMIT 12",
)
def agg_json(table):
    return q.terms_agg(parts(table), "p_size", size=12)


@check(
    "q_agg_terms_large",
    "SELECT * FROM (SELECT 'by_order' AS agg, l_orderkey::VARCHAR AS key, count(*) AS doc_count FROM lineitem GROUP BY 2 "
    "ORDER BY doc_count DESC, key LIMIT 5000) UNION ALL SELECT * FROM (SELECT 'by_part', l_partkey::VARCHAR AS key, "
    "count(*) AS doc_count FROM lineitem GROUP BY 2 HAVING count(*) >= 3 ORDER BY key DESC LIMIT 1500) UNION ALL "
    "SELECT * FROM (SELECT 'by_flag', l_returnflag AS key, count(*) AS doc_count FROM lineitem WHERE l_returnflag <> 'A' "
    "GROUP BY 2 ORDER BY doc_count, key LIMIT 1)",
)
def agg_terms_large(table):
    aggs = {
        "by_order": q.agg_terms("l_orderkey", size=5000),
        "by_part": q.agg_terms("l_partkey", size=1500, order=("key", "desc"), min_doc_count=3),
        "by_flag": q.agg_terms("l_returnflag", size=1, order=("count", "asc"), exclude=["A"]),
    }
    return q.run_aggs(table("lineitem"), aggs)


@check(
    "q_agg_terms_options",
    "WITH c AS (SELECT user_id AS key, count(*) AS doc_count FROM events WHERE user_id NOT IN (3, 5) GROUP BY 1), "
    "t AS (SELECT * FROM c WHERE doc_count >= 2 ORDER BY key DESC LIMIT 20) SELECT key, doc_count, "
    "((SELECT sum(doc_count) FROM c) - (SELECT sum(doc_count) FROM t))::BIGINT AS sum_other_doc_count FROM t",
)
def agg_terms_options(table):
    return q.terms_agg(
        table("events"), "user_id", size=20, order=("key", "desc"), min_doc_count=2, exclude=[3, 5], sum_other=True
    )


@check("q_match_boost", scored_sql(TWO, f"2.5 * {weight_sql(0, TWO[0])} + {weight_sql(1, TWO[1])}", any_sql(TWO)))
def match_boost(table):
    return scored(table, q.bool_(should=[q.match("text", TWO[0], boost=2.5), q.match("text", TWO[1])]))


@check(
    "q_multi_match_minimum",
    scored_sql(
        TWO,
        f"1.5 * greatest(2 * ({weight_sql(0, TWO[0])} + {weight_sql(1, TWO[1])}), 0.0)",
        f"list_contains(t, '{TWO[0]}') AND list_contains(t, '{TWO[1]}')",
    ),
)
def multi_match_minimum(table):
    found = q.search(
        texts(table), "doc_id",
        query=q.multi_match(["text^2"], " ".join(TWO), minimum_should_match="100%", boost=1.5),
        size=None, fields=["doc_id"],
    )
    return found.hits


@check(
    "q_bulk_negative_seq",
    "WITH d AS (SELECT -o_orderkey - 1 AS seq, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) "
    "AS rn FROM orders) SELECT seq, o_custkey::VARCHAR AS _id, CASE WHEN rn = 1 AND c_custkey IS NOT NULL THEN "
    "(c_nationkey + 2)::BIGINT END AS _version, CASE WHEN rn = 1 AND c_custkey IS NOT NULL THEN 200 ELSE 404 END AS status "
    "FROM d LEFT JOIN customer ON c_custkey = o_custkey",
)
def bulk_negative_seq(table):
    actions = as_actions(table("orders"), F.lit("delete"), F.lit(None).cast("string"))
    results = q.bulk_apply(customers(table), actions.withColumn("seq", -F.col("seq") - 1)).results
    return results.select("seq", "_id", "_version", "status")


@check(
    "q_bulk_hot_sparse",
    "SELECT 'hot' AS _id, o_totalprice AS balance FROM orders ORDER BY o_orderkey DESC LIMIT 1",
)
def bulk_hot_sparse(table):
    payload = F.to_json(F.struct(F.col("o_totalprice").alias("balance")))
    actions = as_actions(table("orders"), F.lit("index"), payload, F.lit("hot"))
    # Sequence numbers like time stamps: far apart, all on one document, followed in pieces.
    spaced = actions.withColumn("seq", F.col("seq") * 10_000_000)
    docs = q.bulk_apply(customers(table), spaced, chunk=1000).docs
    return docs.where("_id = 'hot'").select("_id", "balance")


@check(
    "q_upsert_nested",
    "SELECT c_custkey::VARCHAR AS _id, CASE WHEN o_custkey IS NULL THEN c_acctbal ELSE 5.5 END::DOUBLE AS balance, "
    "c_mktsegment AS tier FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON o_custkey = c_custkey",
)
def upsert_nested(table):
    docs = customers(table).select(
        "_index", "_type", "_id", "_version", F.struct("balance", F.col("segment").alias("tier")).alias("account")
    )
    known = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    actions = as_actions(known, F.lit("index"), F.lit('{"account": {"balance": 5.5}}'))
    return q.bulk_apply(docs, actions).docs.select("_id", "account.balance", "account.tier")


@check(
    "q_upsert_rejects",
    "SELECT o_orderkey AS seq, CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 400 END AS refused FROM orders",
)
def upsert_rejects(table):
    payload = (
        F.when(F.col("o_orderpriority") == "2-HIGH", F.lit('{"balance": "abc"}'))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit('{"grade": "M"} zz'))
        .otherwise(F.lit('{"grade": "X"}'))
    )
    results = q.bulk_apply(customers(table), as_actions(table("orders"), F.lit("index"), payload)).results
    return results.select("seq", F.when(F.col("status") >= 400, F.col("status")).alias("refused"))


def _snapshots(table):
    """Three snapshots of two stores, the second of one of them and the third deleted; the stores go on."""
    spark = table.spark
    stores = {name: Store(spark, new_folder(spark, name)) for name in ("customer", "supplier")}
    for name, store in stores.items():
        store.commit(table(name))
    repository = SnapshotRepository(spark, new_folder(spark, "snapshots"))
    repository.create("all", stores)
    repository.create("some", stores, ["supplier"])
    repository.create("old", stores)
    repository.delete("old")
    stores["customer"].commit(table("customer").where("c_acctbal < 0"))
    return repository, stores


@check(
    "q_snapshot_list",
    "SELECT 'all' AS snapshot, 'customer' AS index, c_nationkey AS nation, count(*) AS docs, min(c_name) AS first FROM customer "
    "GROUP BY c_nationkey UNION ALL SELECT unnest(['all', 'some']), 'supplier', n, d, f FROM "
    "(SELECT s_nationkey AS n, count(*) AS d, min(s_name) AS f FROM supplier GROUP BY s_nationkey)",
)
def snapshot_list(table):
    """Every complete snapshot with what its indices hold by nation."""
    repository, _ = _snapshots(table)
    held = []
    for entry in repository.list().where("state = 'SUCCESS'").collect():
        for index in entry["indices"]:
            docs, at = repository.read(entry["snapshot"], index), index[0]
            named = [F.lit(entry["snapshot"]).alias("snapshot"), F.lit(index).alias("index"), F.col(f"{at}_nationkey").alias("nation")]
            held.append(docs.groupBy(*named).agg(F.count(F.lit(1)).alias("docs"), F.min(f"{at}_name").alias("first")))
    return reduce(DataFrame.union, held)


@check(
    "q_snapshot_delete",
    "SELECT c_custkey, 'DELETED' AS old, c_acctbal < 0 AS still FROM customer",
)
def snapshot_delete(table):
    """After one snapshot is deleted: every document of another one, and whether the store still has it."""
    repository, stores = _snapshots(table)
    state = repository.list().where("snapshot = 'old'").first()["state"]
    now = stores["customer"].read().select("c_custkey", F.lit(True).alias("still"))
    kept = repository.read("all", "customer").select("c_custkey").join(now, "c_custkey", "left")
    return kept.select("c_custkey", F.lit(state).alias("old"), F.coalesce("still", F.lit(False)).alias("still"))


@check(
    "q_mappings_typed",
    "SELECT '_doc' AS type, field, data_type, docs FROM (SELECT unnest(['c_custkey', 'c_name', 'c_acctbal', 'c_mktsegment', 'c_nationkey']) AS field, "
    "unnest(['bigint', 'string', 'double', 'string', NULL]) AS data_type, unnest([count(c_custkey), count(c_name), count(c_acctbal), count(c_mktsegment), 0]) AS docs "
    "FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS c_name, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal, "
    "CASE WHEN c_nationkey < 9 THEN c_mktsegment END AS c_mktsegment FROM customer)) WHERE data_type IS NOT NULL",
)
def typed_mappings(table):
    """The fields of a mapping with their types and the number of documents that have them."""
    docs = table("customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_nationkey") < 9, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    fields = catalog.mappings({"customer": docs}, ["customer", "none"])
    held = docs.agg(*(F.count(c).alias(c) for c in docs.columns)).unpivot([], docs.columns, "field", "docs")
    return fields.join(held, "field").select("type", "field", "data_type", "docs")
