"""Compare all registered queries, or those named, with their SQL twins: ``run_oracles.py [folder] [name...]``."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.oracle_compare import compare, open_tables  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = open_tables(folder)
    oracles, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        try:
            problem, seconds, rows = compare(spark, db, name, query, oracles.get(name), folder)
        except Exception as e:  # report and go on
            problem, seconds, rows = f"{type(e).__name__}: {str(e)[:600]}", 0.0, 0
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28} {rows:8} rows {seconds:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
