"""Replacing a table without a moment at which there is none.

Every version of a table is a folder of its own, written whole before anyone is told.
Then one change makes it the table:

* a table by path has a pointer file, ``_CURRENT``, that names the version; it is replaced
  by one rename over the old one (atomic on HDFS and local disks; on an object store,
  where a rename is a put of this small file, likewise);
* a table of the catalog gets its location moved by one ``ALTER TABLE ... SET LOCATION``.

Whoever reads meanwhile sees the old table or the new one. The version before the current
one stays until the next replacement, for readers that began on it; older ones go.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    """(path object, its file system)"""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *parts[1:]])


def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """Write ``df`` whole into a new folder under ``path``; its name.

    With ``partition_by`` rows are rebalanced on those columns first: adaptive execution
    puts a small day into one task and splits a large one by its measured size, so a day
    has as many files as its size asks for, not one per task of the join before it.
    """
    name = f"v-{uuid.uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(_join(path, name))
    return name


def current_version(spark: SparkSession, path: str) -> tuple[str | None, str | None]:
    """(current version, the one before), None where there is none."""
    at, fs = _fs(spark, _join(path, POINTER))
    if not fs.exists(at):
        return None, None
    stream = fs.open(at)
    try:
        text = bytes(stream.readNBytes(4096)).decode()
    finally:
        stream.close()
    names = [*text.split("\n"), "", ""]
    return names[0] or None, names[1] or None


def point(spark: SparkSession, path: str, name: str, before: str | None) -> None:
    """Make ``name`` the current version: a new pointer file takes the old one's place in one rename."""
    jvm = spark.sparkContext._jvm
    at, fs = _fs(spark, _join(path, POINTER))
    fresh, _ = _fs(spark, _join(path, f"_{uuid.uuid4().hex}"))
    out = fs.create(fresh, True)
    out.write(f"{name}\n{before or ''}".encode())
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(fresh), context.makeQualified(at), over)


def drop_versions(spark: SparkSession, path: str, keep: set[str]) -> None:
    """Remove the versions, whole or broken off, that are not in ``keep``."""
    at, fs = _fs(spark, path)
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in keep:
            fs.delete(status.getPath(), True)


def save_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """Replace the table at ``path`` with ``df``, which may read from ``path`` itself."""
    spark = df.sparkSession
    before, _ = current_version(spark, path)
    name = write_version(df, path, partition_by, fmt)
    point(spark, path, name, before)
    drop_versions(spark, path, {name, before or name})
    return path


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """The current version of the table at ``path``; a plain folder of files is read as it is."""
    name, _ = current_version(spark, path)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(_join(path, name) if name else path)


def save_catalog_table(df: DataFrame, table: str, path: str, fmt: str = "parquet") -> str:
    """Create the catalog's ``table`` from ``df``, or replace it by moving its location to a new
    version under ``path``; columns and types stay, as for any reader of the table."""
    spark = df.sparkSession
    have = spark.catalog.tableExists(table)
    if have and spark.table(table).schema.simpleString() != df.schema.simpleString():
        raise ValueError(f"{table} has other columns; drop it first")
    before = current_location(spark, table).rstrip("/").rsplit("/", 1)[-1] if have else None
    name = write_version(df, path, None, fmt)
    where = _join(path, name).replace("'", "\\'")
    if have:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{where}'")
    else:
        spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{where}'")
    spark.catalog.refreshTable(table)
    drop_versions(spark, path, {name, before or name})
    return table


def current_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]
