"""Skew-safe row numbering.

``Window.partitionBy(k).orderBy(v)`` sends every row of a key to one task, and
``Window.orderBy(v)`` (no partition) sends the whole table to one task. Here the
rows are instead sorted through a *range* exchange on (k, v): the sampled range
bounds split a hot key across many partitions. Then

1. ``monotonically_increasing_id`` gives each row (partition id, position);
2. a table with one row per partition (its row count) is prefix-summed; it is
   bounded by the number of shuffle partitions, never by the data, so it is
   broadcast;
3. dense global position g = rows in earlier partitions + position.

For numbering within a key (``rank_within``), rank and count are taken per
(range partition, key) and corrected for the few keys that continue across a
partition edge from a table of at most two rows per partition.

All branches read one range exchange (Spark reuses it). Its partition count is
explicit, so adaptive execution neither coalesces nor splits it and every
branch sees the same partition ids; the remaining columns join the sort key,
so the order inside a partition is total and column pruning cannot fork the
exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POS_BITS = 33  # monotonically_increasing_id = partition id << 33 | position


def _reuse_enabled(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.exchange.reuse", "true").lower() == "true"


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def sorted_partitions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The sorted frame of ``partitions``."""
    return partitions(df, order)[1]


def partitions(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(unsorted, sorted): the rows of one range exchange with ``_pid``, as they
    come, for aggregates that need no order, and sorted, with ``_pos`` too.

    Rows range-partitioned and sorted by ``order`` (names, ascending, NULLs
    first), with ``_pid`` (partition index, in order) and ``_pos`` (0-based
    position inside the partition).

    The remaining columns are appended to the sort key. That breaks ties
    deterministically and makes every consumer read the same columns from the
    range exchange, so column pruning cannot fork it and Spark reuses one
    exchange (a second one would sample its own bounds). The partition count is
    explicit, so adaptive execution neither coalesces nor splits the exchange:
    every consumer sees the same ``_pid`` for the same rows.
    """
    rest = [f for f in df.schema.fields if f.name not in set(order)]
    sort = [F.col(c).asc_nulls_first() for c in order]
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unorderable = [f.name for f in rest if not _orderable(f.dataType)]
    if unorderable or not _reuse_enabled(df):
        raise ValueError(
            "a distributed numbering needs orderable columns and spark.sql.exchange.reuse=true"
            + (f"; drop or convert {', '.join(unorderable)}" if unorderable else ""))
    # range bounds hold the order columns and a hash, not whole rows; inside a
    # partition the remaining columns make the order total
    tie = F.xxhash64(*[F.col(f.name) for f in rest]) if rest else F.lit(0)
    full = sort + [F.col(f.name).asc_nulls_first() for f in rest]
    dealt = df.withColumn("_tie", tie)
    # without an order rows are dealt out evenly, with no sampling and no ranges
    dealt = dealt.repartitionByRange(n, *sort, F.col("_tie")) if sort else dealt.repartition(n)
    s = dealt.sortWithinPartitions(*sort, "_tie", *full[len(sort):]).drop("_tie")
    s = s.withColumn("_mid", F.monotonically_increasing_id())
    return (dealt.withColumn("_pid", F.spark_partition_id().cast("long")),
            s.withColumn("_pid", F.shiftright("_mid", _POS_BITS))
             .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1))
             .drop("_mid"))


def global_position(df: DataFrame, order: Sequence[str], name: str = "_g") -> DataFrame:
    """Add a dense 0-based position in ``order`` (column names, ascending,
    NULLs first)."""
    s = sorted_partitions(df, order)
    sizes = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per shuffle partition: a bounded table, so a single-partition
    # window and a broadcast are safe here.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = s.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_off") + F.col("_pos")).drop("_pid", "_pos", "_off")


def rank_within(df: DataFrame, keys: str | Sequence[str], order: Sequence[str],
                rank_name: str = "rn", count_name: str | None = None) -> DataFrame:
    """``row_number()`` over (partition by keys order by order), plus optionally
    the key's row count, without putting a hot key into one task.

    Rows are range-partitioned on (keys, order), so a hot key spans several
    balanced partitions. Rank and count are first taken per (range partition,
    key). Only a partition's first and last key can continue in another
    partition; their per-partition counts form a table of at most two rows per
    partition (bounded, broadcast) that gives each such (partition, key) the
    rows of its key in earlier partitions and the key's total. NULL keys form
    one group, as in a window's PARTITION BY.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    s = sorted_partitions(df, keys + list(order))
    w = Window.partitionBy("_pid", *keys).orderBy("_pos")
    local = s.select("*", F.row_number().over(w).alias("_lrn"),
                     F.count(F.lit(1)).over(Window.partitionBy("_pid", *keys)).alias("_lcnt"))
    kstruct = F.struct(*[F.col(k) for k in keys])
    ends = s.groupBy("_pid").agg(F.min_by(kstruct, "_pos").alias("_fk"),
                                 F.max_by(kstruct, "_pos").alias("_lk"))

    def same_key(c):
        cond = None
        for k in keys:
            e = F.col(k).eqNullSafe(F.col(c)[k])
            cond = e if cond is None else cond & e
        return cond

    # (partition, key) rows for keys at a partition edge: at most two per partition.
    edge = (local.filter(F.col("_lrn") == 1).join(F.broadcast(ends), "_pid")
                 .filter(same_key("_fk") | same_key("_lk"))
                 .select("_pid", *keys, F.col("_lcnt").alias("_c")))
    by_key = Window.partitionBy(*keys).orderBy("_pid")
    edge = edge.select(
        F.col("_pid").alias("_epid"), *[F.col(k).alias("_e_" + k) for k in keys],
        F.coalesce(F.sum("_c").over(by_key.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_before"),
        F.sum("_c").over(Window.partitionBy(*keys)).alias("_total"))
    cond = F.col("_pid") == F.col("_epid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col("_e_" + k))
    j = local.join(F.broadcast(edge), cond, "left")
    out = j.withColumn(rank_name, F.col("_lrn") + F.coalesce(F.col("_before"), F.lit(0)))
    if count_name:
        out = out.withColumn(count_name, F.coalesce(F.col("_total"), F.col("_lcnt")))
    return out.drop("_pid", "_pos", "_lrn", "_lcnt", "_epid", "_before", "_total",
                    *["_e_" + k for k in keys])


def row_sequence(df: DataFrame, order: Sequence[str], name: str = "seq",
                 start: int | Column = 0) -> DataFrame:
    """Global 1-based sequence in ``order`` (plus ``start``), distributed.

    An empty ``order`` numbers blocks of rows as they are dealt out: a count per partition and
    its prefix sum, no range exchange. Inside a partition all columns order the rows, so
    a task that runs again gives its rows the same numbers.
    """
    start_col = start if isinstance(start, Column) else F.lit(start)
    g = global_position(df, order)
    return g.withColumn(name, start_col + F.col("_g") + 1).drop("_g")
