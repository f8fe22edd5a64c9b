"""Per-call features (operators F1-F8).

Every feature is a ``groupBy(call id)`` aggregate: Spark combines map-side
(partial aggregation) before the shuffle, so a hot call id costs one row per map
task, not one row per detail row. Ordered arrays sort the distinct values of a call
(what the source's GROUP BY produced) instead of an ordered ``ARRAY_AGG``; the sort
gives the rank order without a window over the call.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import all_known, classify_label as label_class, flag, is_known
from ..sources.ivr_schema import (
    OUT, LABEL_DEFAULT, LABEL_RULES, MODULE_MASS_OUTAGE, SENTINEL, STEP_INFO_BY_DNI,
    STEP_INFO_BY_PHONE, STEP_OK,
)

KEY = "calls_ivr_id"


# --- F1 --------------------------------------------------------------------------
def classify_label(df: DataFrame, key: str = KEY, label: str = "calls_vdn_label",
                   rules=LABEL_RULES, default: str = LABEL_DEFAULT,
                   out: str = OUT["label_class"]) -> DataFrame:
    """Distinct (call, label) with the label class."""
    return df.select(key, label, label_class(label, rules, default).alias(out)).distinct()


# --- F2 / F3 / F4 -------------------------------------------------------------------
def _sorted_distinct(df: DataFrame, key: str, cols: Sequence[str], out: str) -> DataFrame:
    """Per key the sorted distinct tuples of ``cols`` (struct order = sort order).

    Two phases: tuples are made distinct by (key, tuple), which deals a hot key's repeats over all
    tasks, and only then collected by key, so a buffer never holds one twice.
    """
    distinct = df.select(key, *cols).distinct()
    return distinct.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in cols]))).alias(out))


def collect_structs(df: DataFrame, key: str = KEY,
                    cols: Sequence[str] = ("document_type", "document_identification"),
                    sentinel: str = SENTINEL, count_name: str = OUT["docs_per_call"],
                    out: str = OUT["documents_of_call"]) -> DataFrame:
    """per key, the array of distinct known tuples in rank order, and its size."""
    g = _sorted_distinct(df.filter(all_known(cols, sentinel)), key, cols, out)
    return g.select(key, F.size(out).cast("bigint").alias(count_name), out)


def collect_parallel(df: DataFrame, key: str = KEY,
                     cols: Sequence[str] = ("document_type", "document_identification"),
                     names: Sequence[str] = (OUT["document_types"], OUT["document_ids"]),
                     sentinel: str = SENTINEL, count_name: str = OUT["docs_per_call"]) -> DataFrame:
    """per key, one array per column, aligned by the same rank."""
    g = collect_structs(df, key, cols, sentinel, count_name, out="_tuples")
    return g.select(key, count_name,
                    *[F.col("_tuples")[c].alias(n) for c, n in zip(cols, names)])


def collect_values(df: DataFrame, key: str = KEY, col: str = "billing_account_id",
                   sentinel: str = SENTINEL, min_count: int = 1,
                   count_name: str = OUT["bills_per_call"],
                   out: str = OUT["bills_per_register"]) -> DataFrame:
    """per key, the sorted array of distinct known values; keys with at
    least ``min_count`` values."""
    g = _sorted_distinct(df.filter(is_known(col, sentinel)), key, [col], out)
    g = g.select(key, F.size(out).cast("bigint").alias(count_name), F.col(out)[col].alias(out))
    if min_count > 1:
        g = g.filter(F.col(count_name) >= min_count)
    return g


# --- F5 - F8 ---------------------------------------------------------------------
def mass_outage_pred(module_name: str = "module_name") -> Column:
    return F.col(module_name) == F.lit(MODULE_MASS_OUTAGE)


def step_ok_pred(step: str, step_name: str = "step_name",
                 step_result: str = "step_result") -> Column:
    return (F.col(step_name) == F.lit(step)) & (F.col(step_result) == F.lit(STEP_OK))


def info_by_phone_pred(refined: bool = False, phone: str = "customer_phone") -> Column:
    pred = step_ok_pred(STEP_INFO_BY_PHONE)
    if refined:
        # The refined flag also needs a phone: calls were flagged without one.
        pred = pred & (F.col(phone) != F.lit(SENTINEL))
    return pred


def info_by_dni_pred() -> Column:
    return step_ok_pred(STEP_INFO_BY_DNI)


def presence_flags(df: DataFrame, flags: Mapping[str, Column], key: str = KEY) -> DataFrame:
    """Per key, 1 if any row meets the predicate, else 0 (one aggregate
    for any number of flags). A NULL predicate counts as not met."""
    return df.groupBy(key).agg(*[F.max(flag(p)).alias(n) for n, p in flags.items()])


def presence_flag(df: DataFrame, pred: Column, name: str, key: str = KEY) -> DataFrame:
    return presence_flags(df, {name: pred}, key)


def presence_flag_by_sum(df: DataFrame, pred: Column, name: str, key: str = KEY) -> DataFrame:
    """the same flag through a per-row 0/1 column and ``SUM >= 1``."""
    rows = df.select(key, flag(pred).alias("_hit"))
    return (rows.groupBy(key)
                .agg(F.when(F.sum("_hit") >= 1, F.lit(1)).otherwise(F.lit(0)).alias(name)))
