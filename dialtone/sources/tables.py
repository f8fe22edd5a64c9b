"""Readers for parquet tables.

Reads are lazy: Catalyst prunes columns and pushes filters into the parquet scan,
so callers select only what they use.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_typed(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "parquet") -> DataFrame:
    """Read with a declared schema (no inference, no extra pass over the files)."""
    return spark.read.schema(schema).format(fmt).load(path)
