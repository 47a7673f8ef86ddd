"""Run registered queries and their SQL twins and compare rows, names and values."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(os.path.join(folder, "*.parquet"))):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(shown(v) for v in value) + "]"
    return repr(value) if not hasattr(value, "isoformat") else value.isoformat()


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(shown(r[i]) for i in order) for r in rows)


def kinds(df):
    alias = {"tinyint": "int", "smallint": "int", "integer": "int", "varchar": "string", "timestamp_ntz": "timestamp"}
    return {f.name: alias.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}


def compare(spark, db, name, query, sql, folder):
    """``None`` if equal, else what differs; and the seconds the Spark side took."""
    start = time.time()
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if sql is None:
        return (None if rows else "no rows"), seconds, len(rows)
    cursor = db.execute(sql)
    sql_names = [c[0] for c in cursor.description]
    sql_types = {c[0]: str(c[1]).lower() for c in cursor.description}
    sql_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(sql_names):
        return f"columns {sorted(df.columns)} / {sorted(sql_names)}", seconds, len(rows)
    spark_types = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean"}
    for column, kind in kinds(df).items():
        if kind in spark_types and spark_types[kind] != sql_types[column]:
            return f"type of {column}: {kind} / {sql_types[column]}", seconds, len(rows)
    left, right = as_rows(df.columns, rows), as_rows(sql_names, sql_rows)
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}", seconds, len(rows)
    for a, b in zip(left, right):
        if a != b:
            return f"values {str(a)[:300]} / {str(b)[:300]}", seconds, len(rows)
    return None, seconds, len(rows)
