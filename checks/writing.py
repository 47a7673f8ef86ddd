"""Write batches, retries, stores and streams of writes."""

from __future__ import annotations

from pyspark.sql import functions as F

import quillspan as q
from checks.registry import check
from quillspan.operators.writes import KEY
from quillspan.plans.durable import new_folder
from quillspan.sources.buckets import BucketStore
from quillspan.sources.store import SnapshotRepository, Store
from quillspan.streaming.continuous import continuous_upsert


def customers(table):
    """Customers as typed documents with a column that only the batch fills."""
    return table("customer").select(
        F.lit("crm").alias("_index"),
        F.lit("customer").alias("_type"),
        F.col("c_custkey").cast("string").alias("_id"),
        (F.col("c_nationkey") + 1).cast("bigint").alias("_version"),
        F.col("c_mktsegment").alias("segment"),
        F.lit(None).cast("string").alias("grade"),
        F.col("c_acctbal").alias("balance"),
    )


def json_customers(table):
    return customers(table).select(
        *KEY,
        "_version",
        F.to_json(F.struct("segment", F.struct(F.struct("balance").alias("money")).alias("account"))).alias("_source"),
    )


PAYLOADS = {
    "3-MEDIUM": '{"segment": null, "grade": "M"}',
    "2-HIGH": '{"grade": "H"}',
}
OTHER_PAYLOAD = '{"grade": "X", "segment": "BUILDING"}'


def as_actions(orders, op, payload, id_value=None):
    return orders.select(
        F.col("o_orderkey").alias("seq"),
        op.alias("op"),
        F.lit("crm").alias("_index"),
        F.lit("customer").alias("_type"),
        (id_value if id_value is not None else F.col("o_custkey").cast("string")).alias("_id"),
        payload.alias("payload"),
    )


def document_payload():
    payload = F.lit(OTHER_PAYLOAD)
    for priority, text in PAYLOADS.items():
        payload = F.when(F.col("o_orderpriority") == priority, F.lit(text)).otherwise(payload)
    return payload


def mixed_actions(table):
    """Every order as an action on its customer: documents, deletes, scripts and empty payloads."""
    urgent, low = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "5-LOW"
    open_, pending = F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "P"
    op = F.when(urgent & pending, "delete").when(low & open_, "script").otherwise("index")
    price = F.col("o_totalprice")
    script = F.when(price < 20000, "unknown").when(price < 150000, "bump").otherwise("reset")
    payload = F.when(low & open_, script).when(price < 3000, F.lit("")).otherwise(document_payload())
    new = F.concat(F.lit("new-"), "o_custkey")
    id_value = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", new).otherwise(F.col("o_custkey").cast("string"))
    return as_actions(table("orders"), op, payload, id_value)


SCRIPTS = {
    "bump": lambda doc: {"grade": F.concat(F.coalesce(doc["grade"], F.lit("")), F.lit("+"))},
    "reset": lambda doc: {"grade": F.lit("r")},
}

# The same batch as SQL: a are the actions, v the values along each key, l the documents after phase one.
MIXED = (
    "a AS (SELECT o_orderkey AS seq, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'new-' || o_custkey ELSE "
    "o_custkey::VARCHAR END AS id, o_orderpriority AS prio, o_totalprice AS price, "
    "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'delete' "
    "WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN 'script' ELSE 'index' END AS op FROM orders), "
    "e AS (SELECT seq, id, true AS act, 0 AS ver, CASE prio WHEN '3-MEDIUM' THEN 'M' WHEN '2-HIGH' THEN 'H' ELSE 'X' END "
    "AS grade, prio <> '2-HIGH' AS set_segment, CASE WHEN prio <> '3-MEDIUM' THEN 'BUILDING' END AS segment, "
    "NULL::DOUBLE AS balance FROM a WHERE op = 'index' AND price >= 3000 "
    "UNION ALL SELECT -1, c_custkey::VARCHAR, false, c_nationkey + 1, NULL, true, c_mktsegment, c_acctbal FROM customer), "
    "w AS (SELECT *, row_number() OVER k AS rn, lag(grade) OVER k AS old_grade, "
    "max(CASE WHEN set_segment THEN seq END) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND "
    "1 PRECEDING) AS old_at FROM e WINDOW k AS (PARTITION BY id ORDER BY seq)), "
    "x AS (SELECT w.*, CASE WHEN NOT w.act THEN w.ver WHEN w.rn = 1 THEN 1 ELSE (w.grade IS DISTINCT FROM w.old_grade OR "
    "(w.set_segment AND w.segment IS DISTINCT FROM o.segment))::INT END AS step FROM w LEFT JOIN e o "
    "ON o.id = w.id AND o.seq = w.old_at), "
    "v AS (SELECT *, (sum(step) OVER (PARTITION BY id ORDER BY seq))::BIGINT AS now FROM x), "
    "l AS (SELECT id, max(now) AS now, arg_max(grade, seq) FILTER (WHERE grade IS NOT NULL) AS grade, "
    "max(CASE WHEN set_segment THEN seq END) AS seg_at, max(balance) AS balance FROM v GROUP BY id), "
    "dl AS (SELECT id, min(seq) AS first FROM a WHERE op = 'delete' GROUP BY id), "
    "sc AS (SELECT seq, id, price, CASE WHEN price < 20000 THEN 'unknown' WHEN price < 150000 THEN 'bump' ELSE 'reset' "
    "END AS name FROM a WHERE op = 'script'), "
    "sr AS (SELECT id, max(CASE WHEN name = 'reset' THEN seq END) AS reset_at, "
    "count(*) FILTER (WHERE name <> 'unknown') AS calls FROM sc GROUP BY id), "
    "sb AS (SELECT sc.id, count(*) AS bumps FROM sc JOIN sr USING (id) WHERE name = 'bump' AND "
    "seq > coalesce(reset_at, -1) GROUP BY sc.id) "
)


def mixed_result(table):
    return q.bulk_apply(customers(table), mixed_actions(table), scripts=SCRIPTS)


@check(
    "q_bulk_apply",
    f"WITH {MIXED} SELECT 'crm' AS _index, 'customer' AS _type, l.id AS _id, "
    "l.now + coalesce(sr.calls, 0) AS _version, s.segment, "
    "CASE WHEN coalesce(sr.calls, 0) = 0 THEN l.grade ELSE (CASE WHEN reset_at IS NOT NULL THEN 'r' ELSE "
    "coalesce(l.grade, '') END) || repeat('+', coalesce(bumps, 0)) END AS grade, l.balance "
    "FROM l JOIN e s ON s.id = l.id AND s.seq = l.seg_at LEFT JOIN sr ON sr.id = l.id LEFT JOIN sb ON sb.id = l.id "
    "WHERE l.id NOT IN (SELECT id FROM dl) "
    "UNION ALL SELECT 'crm', 'customer', l.id, l.now + coalesce(sr.calls, 0), NULL, "
    "CASE WHEN coalesce(sr.calls, 0) = 0 THEN l.grade ELSE (CASE WHEN reset_at IS NOT NULL THEN 'r' ELSE "
    "coalesce(l.grade, '') END) || repeat('+', coalesce(bumps, 0)) END, l.balance "
    "FROM l LEFT JOIN sr ON sr.id = l.id LEFT JOIN sb ON sb.id = l.id "
    "WHERE l.seg_at IS NULL AND l.id NOT IN (SELECT id FROM dl)",
)
def bulk_apply(table):
    return mixed_result(table).docs


@check(
    "q_bulk_phase_order",
    f"WITH {MIXED} SELECT seq, 'crm' AS _index, 'customer' AS _type, id AS _id, now AS _version, "
    "CASE WHEN rn = 1 THEN 201 ELSE 200 END AS status, NULL::BOOLEAN AS found, NULL AS error FROM v WHERE act "
    "UNION ALL SELECT seq, 'crm', 'customer', id, NULL, 400, NULL, 'invalid action' FROM a "
    "WHERE op = 'index' AND price < 3000 "
    "UNION ALL SELECT a.seq, 'crm', 'customer', a.id, CASE WHEN a.seq = dl.first THEN l.now + 1 END, "
    "CASE WHEN a.seq = dl.first AND l.id IS NOT NULL THEN 200 ELSE 404 END, a.seq = dl.first AND l.id IS NOT NULL, NULL "
    "FROM a JOIN dl ON dl.id = a.id LEFT JOIN l ON l.id = a.id WHERE a.op = 'delete' "
    "UNION ALL SELECT sc.seq, 'crm', 'customer', sc.id, CASE WHEN name <> 'unknown' AND dl.id IS NULL THEN l.now + "
    "count(*) FILTER (WHERE name <> 'unknown') OVER (PARTITION BY sc.id ORDER BY sc.seq) END, "
    "CASE WHEN name = 'unknown' THEN 400 WHEN l.id IS NOT NULL AND dl.id IS NULL THEN 200 ELSE 404 END, NULL, "
    "CASE WHEN name = 'unknown' THEN 'unknown script' WHEN l.id IS NULL OR dl.id IS NOT NULL THEN 'document missing' END "
    "FROM sc LEFT JOIN l ON l.id = sc.id LEFT JOIN dl ON dl.id = sc.id",
)
def bulk_results(table):
    return mixed_result(table).results


UPSERTS = MIXED.replace(
    "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'delete' "
    "WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN 'script' ELSE 'index' END",
    "'index'",
).replace(" AND price >= 3000", "")


def upsert_actions(table):
    new = F.concat(F.lit("new-"), "o_custkey")
    id_value = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", new).otherwise(F.col("o_custkey").cast("string"))
    return as_actions(table("orders"), F.lit("index"), document_payload(), id_value)


@check(
    "q_upsert_merge",
    f"WITH {UPSERTS} SELECT l.id AS _id, now AS _version, s.segment, l.grade, l.balance FROM l "
    "LEFT JOIN e s ON s.id = l.id AND s.seq = l.seg_at",
)
def upsert_merge(table):
    docs = q.bulk_apply(customers(table), upsert_actions(table)).docs
    return docs.select("_id", "_version", "segment", "grade", "balance")


@check(
    "q_upsert_noop",
    f"WITH {UPSERTS} SELECT seq, id AS _id, now AS _version, CASE WHEN rn = 1 THEN 201 ELSE 200 END AS status "
    "FROM v WHERE act",
)
def upsert_noop(table):
    results = q.bulk_apply(customers(table), upsert_actions(table)).results
    return results.select("seq", "_id", "_version", "status")


@check(
    "q_upsert_json",
    f"WITH {UPSERTS} SELECT l.id AS _id, now AS _version, s.segment, l.grade, l.balance FROM l "
    "LEFT JOIN e s ON s.id = l.id AND s.seq = l.seg_at",
)
def upsert_json(table):
    docs = q.bulk_apply_json(json_customers(table), upsert_actions(table)).docs
    return docs.select(
        "_id",
        "_version",
        F.get_json_object("_source", "$.segment").alias("segment"),
        F.get_json_object("_source", "$.grade").alias("grade"),
        F.get_json_object("_source", "$.account.money.balance").cast("double").alias("balance"),
    )


@check(
    "q_upsert_one",
    "SELECT c_custkey::VARCHAR AS _id, (c_nationkey + 1 + (c_custkey = 17)::INT)::BIGINT AS _version, "
    "CASE WHEN c_custkey = 17 THEN 'A' END AS grade FROM customer",
)
def upsert_one(table):
    docs = q.upsert(customers(table), "crm", "customer", "17", '{"grade": "A"}').docs
    return docs.select("_id", "_version", "grade")


@check(
    "q_bulk_delete",
    "WITH d AS (SELECT o_orderkey AS seq, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn "
    "FROM orders) SELECT seq, o_custkey::VARCHAR AS _id, CASE WHEN rn = 1 AND c_custkey IS NOT NULL THEN "
    "(c_nationkey + 2)::BIGINT END AS _version, CASE WHEN rn = 1 AND c_custkey IS NOT NULL THEN 200 ELSE 404 END AS status, "
    "rn = 1 AND c_custkey IS NOT NULL AS found FROM d LEFT JOIN customer ON c_custkey = o_custkey",
)
def bulk_delete(table):
    actions = as_actions(table("orders"), F.lit("delete"), F.lit(None).cast("string"))
    results = q.bulk_apply(customers(table), actions).results
    return results.select("seq", "_id", "_version", "status", "found")


@check(
    "q_script_update",
    "WITH n AS (SELECT o_custkey, count(*) AS calls, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, "
    "string_agg(CASE o_orderstatus WHEN 'F' THEN 'f' ELSE 'o' END, '' ORDER BY o_orderkey) AS trail "
    "FROM orders GROUP BY 1) "
    "SELECT c_custkey::VARCHAR AS _id, (c_nationkey + 1 + coalesce(calls, 0))::BIGINT AS _version, trail AS grade, "
    "round(c_acctbal + 10 * coalesce(f, 0), 2) AS balance FROM customer LEFT JOIN n ON c_custkey = o_custkey",
)
def script_update(table):
    def trail(letter):
        return lambda doc: F.concat(F.coalesce(doc["grade"], F.lit("")), F.lit(letter))

    scripts = {
        "finish": lambda doc: {"grade": trail("f")(doc), "balance": doc["balance"] + 10},
        "touch": lambda doc: {"grade": trail("o")(doc)},
    }
    name = F.when(F.col("o_orderstatus") == "F", "finish").otherwise("touch")
    actions = as_actions(table("orders"), F.lit("script"), name)
    docs = q.bulk_apply(customers(table), actions, scripts=scripts).docs
    return docs.select("_id", "_version", "grade", F.round("balance", 2).alias("balance"))


# A conversation's turns are the attempts of one action; users are busy (429), the system call fails.
def attempts(table):
    status = F.when(F.col("role") == "user", 429).when(F.col("role") == "assistant", 200 + F.col("turn"))
    return table("conversations").select(
        F.col("conv_id").alias("seq"), (F.col("turn") + 1).alias("attempt"), status.cast("int").alias("status"),
        F.length("text").alias("size"),
    )


RETRIED = (
    "WITH l AS (SELECT conv_id AS seq, turn + 1 AS attempt, (CASE role WHEN 'user' THEN 429 WHEN 'assistant' THEN "
    "200 + turn END)::INT AS status, length(text)::INT AS size FROM conversations), "
    "k AS (SELECT * FROM l WHERE attempt <= 5 AND status IS NOT NULL), "
    "p AS (SELECT seq, coalesce(min(attempt) FILTER (WHERE status <> 429), max(attempt)) AS attempt FROM k GROUP BY seq) "
)


@check("q_retry_merge", RETRIED + "SELECT k.* FROM k JOIN p ON p.seq = k.seq AND p.attempt = k.attempt")
def retry_merge(table):
    return q.merge_attempts(attempts(table), ["seq"])


@check(
    "q_bulk_errors",
    RETRIED + "SELECT bool_or(status >= 400) AS errors FROM k JOIN p ON p.seq = k.seq AND p.attempt = k.attempt",
)
def bulk_errors(table):
    return q.batch_errors(q.merge_attempts(attempts(table), ["seq"]))


DOOMED = "event_type = 'error' OR value < 10"


def doomed():
    return q.bool_(should=[q.term("event_type", "error"), q.range_("value", ("lt", 10))])


@check("q_delete_by_query", f"SELECT event_id, user_id, event_type, value FROM events WHERE NOT ({DOOMED})")
def delete_by_query(table):
    survivors, _ = q.delete_by_query(table("events"), doomed(), index_col="event_type")
    return survivors.select("event_id", "user_id", "event_type", "value")


@check(
    "q_delete_stats",
    f"SELECT event_type, count(*) AS total, count(*) AS successful, 0::BIGINT AS failed FROM events WHERE {DOOMED} GROUP BY 1",
)
def delete_stats(table):
    _, stats = q.delete_by_query(table("events"), doomed(), index_col="event_type")
    return stats


@check(
    "q_snapshot_roundtrip",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 3::BIGINT AS version FROM orders",
)
def snapshot_roundtrip(table):
    spark = table.spark
    orders = table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    stores = {"orders": Store(spark, new_folder(spark, "orders"))}
    repository = SnapshotRepository(spark, new_folder(spark, "snapshots"))
    stores["orders"].commit(orders)
    repository.create("before", stores)
    stores["orders"].commit(q.delete_by_query(orders, q.term("o_orderstatus", "F"), "o_orderstatus")[0])
    versions = repository.restore("before", stores)
    return stores["orders"].read().withColumn("version", F.lit(versions["orders"]).cast("bigint"))


@check(
    "q_stream_upsert",
    f"WITH {UPSERTS} SELECT l.id AS _id, now AS _version, s.segment, l.grade, l.balance FROM l "
    "LEFT JOIN e s ON s.id = l.id AND s.seq = l.seg_at",
)
def stream_upsert(table):
    spark = table.spark
    store = Store(spark, new_folder(spark, "customers"))
    store.commit(customers(table))
    continuous_upsert(upsert_actions(table.stream), store, new_folder(spark, "progress")).awaitTermination()
    return store.read().select("_id", "_version", "segment", "grade", "balance")


@check(
    "q_stream_upsert_buckets",
    f"WITH {UPSERTS} SELECT l.id AS _id, now AS _version, s.segment, l.grade, l.balance FROM l "
    "LEFT JOIN e s ON s.id = l.id AND s.seq = l.seg_at",
)
def stream_upsert_buckets(table):
    spark = table.spark
    store = BucketStore(spark, new_folder(spark, "customers"), buckets=16)
    store.commit(customers(table))
    continuous_upsert(upsert_actions(table.stream), store, new_folder(spark, "progress")).awaitTermination()
    return store.read().select("_id", "_version", "segment", "grade", "balance")


# Only the customers of some segments are written to; the buckets of the others keep their files.
@check(
    "q_upsert_buckets",
    "SELECT c_custkey::VARCHAR AS _id, (c_nationkey + 1 + coalesce(o.n, 0))::BIGINT AS _version, c_mktsegment AS segment, "
    "CASE WHEN o.n > 0 THEN 'late' END AS grade, c_acctbal AS balance "
    "FROM customer LEFT JOIN (SELECT o_custkey, 1 AS n FROM orders WHERE o_totalprice > 300000 GROUP BY 1) o ON o_custkey = c_custkey",
)
def upsert_buckets(table):
    spark = table.spark
    store = BucketStore(spark, new_folder(spark, "customers"), buckets=64)
    store.commit(customers(table))
    late = as_actions(table("orders").where("o_totalprice > 300000"), F.lit("index"), F.lit('{"grade": "late"}'))
    docs = store.apply(late).docs
    store.vacuum()
    return docs.select("_id", F.col("_version"), "segment", "grade", "balance")
