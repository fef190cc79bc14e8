"""Shared scratch folders: where a job stores tables that later stages read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, or below the warehouse where that is unset; every executor sees both."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def scratch_table(spark: SparkSession, label: str) -> str:
    """A new table name in the current database."""
    return f"{label}_{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
