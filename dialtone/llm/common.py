"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_arrow_batches(spark: SparkSession, rows: int = 2000, size: str = "8m") -> None:
    """Keep a Python worker's batch small: long texts come by the megabyte."""
    spark.conf.set(ARROW_ROWS, str(rows))
    spark.conf.set(ARROW_BYTES, size)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share.

    A cluster names it in ``spark.checkpoint.dir``. A scratch folder is made only
    in local mode, where driver and executors are one process.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if not folder:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="dialtone-llm-")
        sc.setCheckpointDir(named)
        folder = sc.getCheckpointDir()
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later plans start from
    the written table, whatever executors are lost meanwhile."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_columns(df: DataFrame, source: str, fields: list[T.StructField],
                   fn: Callable[[list], list[list]]) -> DataFrame:
    """``df`` with new columns computed batch by batch from one text column.

    ``fn`` gets the column of an Arrow batch as a list of UTF-8 ``bytes`` (or
    None) and returns one list per new field. Input columns whose names clash
    with the new ones (case does not count) give way to them.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in new]
    at = kept.index(source)
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    types = [_arrow_type(f.dataType) for f in fields]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, at):
                values = fn(utf8(part.column(at)))
                arrays = [pa.array(v, type=t) for v, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=names)

    return df.select(*kept).mapInArrow(run, schema)


def utf8(column: pa.Array) -> list:
    """The UTF-8 bytes of a string column, None for null."""
    big = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if big else pa.binary()).to_pylist()


def _pieces(batch: pa.RecordBatch, at: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts of ``batch`` with about ``most`` bytes of column ``at`` each."""
    if batch.num_rows == 0:
        return
    size = batch.column(at).nbytes
    rows = max(1, batch.num_rows * most // max(size, 1))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def hash_share(*columns: Column, salt: str = "") -> Column:
    """A reproducible pseudo-random number from [0, 1) per row."""
    return (F.pmod(F.xxhash64(*columns, F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))).cast("double")
