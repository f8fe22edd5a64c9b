"""Per-call summary.

The source builds the summary by reading the detail nine times and joining
eight grouped results on the call id. Here every feature comes from ONE
``groupBy(call id)`` aggregate (partial aggregation map-side, one shuffle): the
repeat flags, computed per phone, enter it as extra rows through a UNION rather
than a join. ``explode_outer`` then restores the source's row fan-out (one row per
label, per known phone and per (phone, start) variant of a call).

Two inputs give the same rows: ``summary_from_tables`` reads calls, modules and steps
(``facts``: no join at all), ``build_summary`` a detail that was written before.

Semantics kept from the source:
* a call with k labels and p known phones yields k * max(p, 1) rows (times the
  distinct (phone, start) variants of the call in the repeat flags);
* a call without known documents / accounts gets NULL arrays, not empty ones;
* a NULL call id groups into one base row whose features are all NULL, since
  NULL never matches in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import all_known, classify_label as label_class, flag, is_known
from ..sources.ivr_schema import BASE_COLUMNS, SENTINEL, SUMMARY_COLUMNS
from . import facts
from . import features as feat
from .recency import recency_flags

KEY = "calls_ivr_id"
PHONE_SCORE_COLS = ("calls_phone_number", "customer_phone", "billing_account_id")
DOC_COLS = ("document_type", "document_identification")
BEST_PAYLOAD = BASE_COLUMNS + ["customer_phone", "billing_account_id"]


# --- S1 / S2 -----------------------------------------------------------------------
def base_by_max(df: DataFrame, key: str = KEY, cols=BASE_COLUMNS) -> DataFrame:
    """One row per call, column-wise MAX of the call columns."""
    return df.groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


def completeness_score(cols=PHONE_SCORE_COLS, sentinel: str = SENTINEL) -> Column:
    """One point per column that is neither NULL nor the sentinel."""
    score = F.lit(0)
    for c in cols:
        score = score + flag(is_known(c, sentinel))
    return score


def _scored_row(payload, score_cols, sentinel) -> Column:
    # max over this struct compares field by field: highest score first, then
    # the payload columns, each descending with NULLs last -- a full,
    # deterministic tie-break. Being an aggregate, it combines map-side: a hot
    # call costs one row per map task.
    return F.struct(completeness_score(score_cols, sentinel).alias("_score"),
                    *[F.col(c) for c in payload])


def best_row(df: DataFrame, key: str = KEY, cols=None,
             score_cols=PHONE_SCORE_COLS, sentinel: str = SENTINEL) -> DataFrame:
    """Per call, the row with the highest completeness score.

    Ties (frequent) are broken by the listed columns, each descending with NULLs
    last, so the result is deterministic.
    """
    cols = list(cols or BEST_PAYLOAD)
    g = df.groupBy(key).agg(F.max(_scored_row(cols, score_cols, sentinel)).alias("_best"))
    return g.select(key, *[F.col("_best")[c].alias(c) for c in cols])


# --- S3 / S4 -----------------------------------------------------------------------
def _arr_null_if_empty(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def _out_base(prefix: str = "calls_") -> list[Column]:
    return [F.col(c).alias(c[len(prefix):]) for c in BASE_COLUMNS]


def _select_summary(df: DataFrame) -> DataFrame:
    return df.select(*SUMMARY_COLUMNS)


def build_summary(detail: DataFrame, method: str = "max", key: str = KEY,
                  calls: DataFrame | None = None) -> DataFrame:
    """S3 (method='max') and S4 (method='best_row') summary tables, 20 columns.

    ``calls``: optionally the prefixed call rows the detail was built from
    (``detail.prefixed_calls``). The repeat flags only read (call id, phone,
    start), which the detail copies unchanged from every call (the left joins
    keep all calls), so they can be computed from the calls alone instead of
    from the detail's many rows per call.
    """
    _check(method)
    used = [key, *BASE_COLUMNS, "calls_vdn_label", *DOC_COLS, "customer_phone",
            "billing_account_id", "module_name", "step_name", "step_result"]
    rows_ = detail.select(*used, F.lit(True).alias("_det")).unionByName(
        _repeat_rows(calls if calls is not None else detail, key).withColumn("_det", F.lit(False)),
        allowMissingColumns=True)
    # NULL ids never join in the source: their features are NULL, so their rows
    # enter the group's MAX only and no array is collected from them.
    d = F.col("_det") & F.col(key).isNotNull()

    def on_detail(c: Column) -> Column:
        return F.when(d, c)

    if method == "max":
        base_aggs = [F.max(c).alias(c) for c in BASE_COLUMNS]
    else:
        base_aggs = [F.max(F.when(F.col("_det"), _scored_row(BEST_PAYLOAD, PHONE_SCORE_COLS, SENTINEL)))
                     .alias("_best")]
    agg = rows_.groupBy(key).agg(
        *base_aggs,
        F.collect_set(on_detail(F.struct("calls_vdn_label"))).alias("_labels"),
        F.collect_set(F.when(d & all_known(DOC_COLS), F.struct(*DOC_COLS))).alias("_docs"),
        F.collect_set(F.when(d & (F.col("customer_phone") != F.lit(SENTINEL)),
                             F.col("customer_phone"))).alias("_phones"),
        F.collect_set(F.when(d & is_known("billing_account_id"), F.col("billing_account_id"))).alias("_bills"),
        F.max(on_detail(flag(feat.mass_outage_pred()))).alias("masiva_lg"),
        F.max(on_detail(flag(feat.info_by_phone_pred(refined=True)))).alias("info_by_phone_lg"),
        F.max(on_detail(flag(feat.info_by_dni_pred()))).alias("info_by_dni_lg"),
        F.collect_set("_rv").alias("_recs"),
    )
    return _fan_out(agg, method, key)


def summary_from_tables(calls: DataFrame, modules: DataFrame, steps: DataFrame, method: str = "max",
                        key: str = KEY) -> DataFrame:
    """The same summary from prefixed calls, modules and steps: two aggregates over tagged unions
    (``facts``) instead of the detail's joins."""
    _check(method)
    rows_ = facts.call_rows_and_values(calls, modules, steps, key).unionByName(
        _repeat_rows(calls, key), allowMissingColumns=True)
    known_call = F.coalesce(F.col("_call"), F.lit(False)) & F.col(key).isNotNull()

    def any_of(name: str) -> Column:
        return flag(F.max(name) >= 1)

    base_aggs = ([F.max(c).alias(c) for c in BASE_COLUMNS] if method == "max"
                 else [facts.best_call_row(key).alias("_best")])
    # rows are distinct by call by now: they go to their call as they are, which is less than
    # a buffer of sets for each of them
    agg = rows_.repartition(F.col(key)).groupBy(key).agg(
        F.count_if("_call").alias("_calls"), *base_aggs,
        F.collect_set(F.when(known_call, F.struct("calls_vdn_label"))).alias("_labels"),
        F.collect_set(F.when(F.col(DOC_COLS[0]).isNotNull(), F.struct(*DOC_COLS))).alias("_docs"),
        F.collect_set("customer_phone").alias("_phones"), F.collect_set("billing_account_id").alias("_bills"),
        any_of("masiva_lg").alias("masiva_lg"), any_of("by_known_phone").alias("info_by_phone_lg"),
        any_of("by_dni").alias("info_by_dni_lg"), F.collect_set("_rv").alias("_recs"),
    ).where("_calls > 0")
    return _fan_out(agg, method, key)


def _check(method: str) -> None:
    if method not in ("max", "best_row"):
        raise ValueError("method must be 'max' or 'best_row'")


def _repeat_rows(calls: DataFrame, key: str) -> DataFrame:
    """The repeat flags, one row per distinct (call, phone, start). They enter the aggregate through
    a UNION instead of a join after it: the summary is then shuffled once, by call id."""
    return recency_flags(calls).select(
        key, F.struct(F.col("calls_phone_number").alias("p"), F.col("calls_start_date").alias("s"),
                      F.col("repeated_phone_24H").alias("rep"),
                      F.col("cause_recall_phone_24H").alias("cause")).alias("_rv")).filter(F.col(key).isNotNull())


def _fan_out(agg: DataFrame, method: str, key: str) -> DataFrame:
    """One row per distinct label, known phone and (phone, start) variant of a call, as in the source."""
    label_t = T.StructType([T.StructField("calls_vdn_label", T.StringType())])
    if method == "best_row":
        agg = agg.select("*", *[F.col("_best")[c].alias(c) for c in BASE_COLUMNS]).drop("_best")
    known_id = F.col(key).isNotNull()

    def keyed(c: Column) -> Column:
        # NULL ids never join in the source: their features are NULL.
        return F.when(known_id, c)

    docs = _arr_null_if_empty(F.array_sort("_docs"))
    shaped = agg.select(
        key, *BASE_COLUMNS,
        F.when(known_id, F.col("_labels"))
         .otherwise(F.array(F.lit(None).cast(label_t))).alias("_labels"),
        keyed(docs["document_type"]).alias("document_type"),
        keyed(docs["document_identification"]).alias("document_identification"),
        keyed(F.col("_phones")).alias("_phones"),
        keyed(_arr_null_if_empty(F.array_sort("_bills"))).alias("billing_account_id"),
        keyed(F.col("masiva_lg")).alias("masiva_lg"),
        keyed(F.col("info_by_phone_lg")).alias("info_by_phone_lg"),
        keyed(F.col("info_by_dni_lg")).alias("info_by_dni_lg"),
        keyed(F.col("_recs")).alias("_recs"),
    )
    shaped = shaped.withColumn("_label", F.explode_outer("_labels"))
    shaped = shaped.withColumn("customer_phone", F.explode_outer("_phones"))
    shaped = shaped.withColumn("_rec", F.explode_outer("_recs"))
    out = shaped.select(
        "*",
        F.when(F.col("_label").isNotNull(), label_class(F.col("_label")["calls_vdn_label"]))
         .alias("vdn_aggregation"),
        F.col("_rec")["rep"].alias("repeated_phone_24H"),
        F.col("_rec")["cause"].alias("cause_recall_24H"))
    return _select_summary(out.withColumnRenamed(key, "ivr_id").select(
        "*", *_out_base()))
