"""Profiling operators over the detail table (P1-P7): how many identifiers,
documents, phones or accounts each call carries.

All are aggregates (partial aggregation before the shuffle). Exact distinct
counts use Spark's two-phase distinct expansion, never one task per key.

``ordered=True`` adds the source's final ORDER BY (ascending, NULLs first), a
range-partitioned global sort; results are unordered otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import all_known, is_known
from ..sources.ivr_schema import OUT, SENTINEL
from .sequence import rank_within

KEY = "calls_ivr_id"
DOC_COLS = ("document_type", "document_identification")


def key_cardinality(df: DataFrame, key: str = KEY) -> DataFrame:
    """Non-NULL key count vs distinct key count (one row)."""
    return df.agg(F.count(key).alias(OUT["rows"]),
                  F.count_distinct(key).alias(OUT["distinct_rows"]))


def value_combinations(df: DataFrame, key: str = KEY, cols: Sequence[str] = DOC_COLS,
                       sentinel: str = SENTINEL) -> DataFrame:
    """Each known (key, values) combination with its repeat count."""
    return (df.filter(all_known(cols, sentinel)).groupBy(key, *cols)
              .agg(F.count(F.lit(1)).alias(OUT["repeats"])))


def combination_coverage(df: DataFrame, key: str = KEY, cols: Sequence[str] = DOC_COLS,
                         sentinel: str = SENTINEL) -> DataFrame:
    """Distinct keys vs number of combinations (one row)."""
    combos = value_combinations(df, key, cols, sentinel)
    return combos.agg(F.count_distinct(key).alias(OUT["distinct_keys"]),
                      F.count(F.lit(1)).alias(OUT["combinations"]))


def values_per_key_histogram(df: DataFrame, key: str = KEY, cols: Sequence[str] = DOC_COLS,
                             sentinel: str = SENTINEL, sep: str | None = "-") -> DataFrame:
    """How many keys carry n distinct values, n = 1, 2, ...

    Distinct values are counted on the joined text ``a-b`` like the source, so
    ('x-y', 'z') and ('x', 'y-z') count as one. ``sep=None`` counts the tuples themselves.
    """
    joined = (F.struct(*[F.col(c) for c in cols]) if sep is None
              else F.concat(*sum([[F.col(c), F.lit(sep)] for c in cols], [])[:-1]))
    per_key = (df.filter(all_known(cols, sentinel)).groupBy(key)
                 .agg(F.count_distinct(joined).alias(OUT["values_per_key"])))
    n = OUT["values_per_key"]
    return per_key.groupBy(n).agg(F.count(n).alias(OUT["keys_per_count"]))


def ranked_values(df: DataFrame, key: str = KEY, cols: Sequence[str] = DOC_COLS,
                  sentinel: str = SENTINEL, min_count: int = 2,
                  count_name: str = OUT["docs_per_call"], skew_safe: bool = True,
                  ordered: bool = False) -> DataFrame:
    """P5: distinct known values per key with their rank in the key and the
    key's value count; keys with at least ``min_count`` values.

    ``skew_safe`` numbers rows through a range-partitioned sort (see
    ``sequence.rank_within``), so one key with a third of all rows is spread
    over many tasks; otherwise a plain window per key is used.
    """
    distinct = df.filter(all_known(cols, sentinel)).select(key, *cols).distinct()
    if skew_safe:
        ranked = rank_within(distinct, key, list(cols), rank_name="rn", count_name=count_name)
    else:
        w = Window.partitionBy(key).orderBy(*cols)
        ranked = distinct.select(
            key, *cols, F.row_number().over(w).alias("rn"),
            F.count(F.lit(1)).over(Window.partitionBy(key)).alias(count_name))
    ranked = ranked.select(key, *cols, F.col("rn").cast("int").alias("rn"),
                           F.col(count_name).cast("bigint").alias(count_name))
    out = ranked.filter(F.col(count_name) >= min_count)
    return out.orderBy(key, "rn") if ordered else out


def distinct_per_group(df: DataFrame, key: str = KEY, col: str = "customer_phone",
                       sentinel: str = SENTINEL,
                       count_name: str = OUT["phones_per_register"],
                       ordered: bool = False) -> DataFrame:
    """Distinct count of ``col`` per (key, col) -- 1 by construction. (The
    summary collects the same phones in its aggregate.)"""
    out = (df.filter(F.col(col) != F.lit(sentinel)).groupBy(key, col)
             .agg(F.count_distinct(col).alias(count_name)))
    return out.orderBy(key) if ordered else out


def multi_valued_keys(df: DataFrame, key: str = KEY, col: str = "billing_account_id",
                      sentinel: str = SENTINEL, count_name: str = OUT["bills_per_register"],
                      min_count: int = 2, ordered: bool = False) -> DataFrame:
    """Keys with at least ``min_count`` distinct known values (HAVING)."""
    out = (df.filter(is_known(col, sentinel)).groupBy(key)
             .agg(F.count_distinct(col).alias(count_name))
             .filter(F.col(count_name) >= min_count))
    return out.orderBy(key) if ordered else out
