"""Static table loaders (S7): parquet scans whose column pruning and filter pushdown
are left to Catalyst."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table; select columns afterwards so the scan prunes them."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_dimension(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                   **options) -> DataFrame:
    """Dimension seed data (drivers, teams, circuits) from parquet or CSV with a declared schema."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("header", "true")
    return reader.load(path)
