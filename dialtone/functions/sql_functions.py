"""SQL functions of a session or of the catalog.

``clean_int`` is a SQL function with an expression body, so Catalyst inlines it like any
built-in (no Python UDF round trip).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .scalar import CLEAN_INT_DEFAULT

_BODY = f"(x BIGINT) RETURNS BIGINT RETURN IF(x IS NULL, {CLEAN_INT_DEFAULT}, x)"


def register_clean_int(spark: SparkSession, name: str = "clean_int") -> str:
    """For this session."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{_BODY}")
    return name


def create_clean_int(spark: SparkSession, schema: str, name: str = "clean_int") -> str:
    """In a schema of the catalog, for every session that shares it; replaces one of that name."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.sql(f"CREATE OR REPLACE FUNCTION {schema}.{name}{_BODY}")
    return f"{schema}.{name}"


def drop_clean_int(spark: SparkSession, schema: str, name: str = "clean_int") -> None:
    spark.sql(f"DROP FUNCTION IF EXISTS {schema}.{name}")
