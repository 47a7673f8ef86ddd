"""Reading tables and JSON documents as collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(scan: DataFrame, least: int | None = None) -> DataFrame:
    """Deal out a scan that has fewer tasks than the cluster has cores.

    Text analysis and JSON work are bound by the processor, so a few large row groups would keep
    most cores idle.  A scan with enough tasks of its own is returned as it is.  Use on plain scans only:
    asking a plan with shuffles for its partitions would run them.
    """
    cores = least or scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def as_documents(
    df: DataFrame, id_col: str, index: str | Column, type_name: str | Column, source: list[str] | None = None
) -> DataFrame:
    """Rows as JSON documents ``_index, _type, _id, _version, _source``, all of version 1."""
    fields = source or [c for c in df.columns if c != id_col]
    return df.select(
        (F.lit(index) if isinstance(index, str) else index).alias("_index"),
        (F.lit(type_name) if isinstance(type_name, str) else type_name).alias("_type"),
        F.col(id_col).cast("string").alias("_id"),
        F.lit(1).cast("bigint").alias("_version"),
        F.to_json(F.struct(*fields)).alias("_source"),
    )


def read_json_documents(spark: SparkSession, path: str, index: str, type_name: str, id_field: str) -> DataFrame:
    """Files of one JSON document per line, kept as text, with the id taken from a field."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(
        F.lit(index).alias("_index"),
        F.lit(type_name).alias("_type"),
        F.get_json_object("value", f"$.{id_field}").alias("_id"),
        F.lit(1).cast("bigint").alias("_version"),
        F.col("value").alias("_source"),
    )


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Archived responses, one per line, as ``payload``."""
    return spark.read.text(path).withColumnRenamed("value", "payload")
