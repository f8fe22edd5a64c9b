"""Facts of a call straight from calls, modules and steps, without a join.

The detail joins three tables, yet what a summary, a flag or a count needs of a call are
maxima, sets and multiplicities, which aggregates give:

1. modules and steps, tagged, go through one union and one aggregate by (call id, module
   sequence): is there such a module, how often, and what do its steps say. Steps
   whose module is missing go here, as they do in the detail.
2. calls and what is known of their modules go through a second union and one
   aggregate by call id. Ids without a call go.

Both aggregates combine map-side, so a hot call or module is one row per task. Where values
are collected, the combinations of a step's known values are made distinct by module, kept
where a window finds the module, made distinct by call, and only then meet by call. Multiplicities
follow from the counts: a module row of k copies with s steps makes k * max(s, 1) rows of
the detail, a call id of c rows and r such rows c * max(r, 1). The best row's score is
the sum of a call's part and a step's part, so the best of all pairs is the best call row
beside the best step row.

NULLs: a NULL call id matches no module, but its rows are one group; a module with a NULL
sequence has no steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import all_known, flag, is_known
from ..sources.ivr_schema import BASE_COLUMNS, CALL_ID, MODULE_SEQ, OUT
from .features import info_by_dni_pred, info_by_phone_pred, mass_outage_pred

KEY = "calls_ivr_id"
PHONE = "calls_phone_number"
STEP_SCORE_COLS = ("customer_phone", "billing_account_id")
DOC_COLS = ("document_type", "document_identification")


def module_predicates() -> dict[str, Column]:
    return {"masiva_lg": mass_outage_pred()}


def step_predicates() -> dict[str, Column]:
    return {"by_phone": info_by_phone_pred(), "by_known_phone": info_by_phone_pred(refined=True), "by_dni": info_by_dni_pred()}


def step_score() -> Column:
    """How many of a step's scored columns are known."""
    a, b = (flag(is_known(c)) for c in STEP_SCORE_COLS)
    return a + b


def _best(score: Column, columns: Sequence[str]) -> Column:
    return F.struct(score.alias("_score"), *[F.col(c) for c in columns])


def _tagged(modules: DataFrame, steps: DataFrame, key: str, seq: str) -> DataFrame:
    m = modules.where(F.col(key).isNotNull()).select(key, seq, F.lit(True).alias("_module"), "module_name")
    s = steps.where(F.col(key).isNotNull() & F.col(seq).isNotNull()).select(
        key, seq, F.lit(False).alias("_module"), "step_name", "step_result", *DOC_COLS, *STEP_SCORE_COLS)
    return m.unionByName(s, allowMissingColumns=True)


def module_facts(modules: DataFrame, steps: DataFrame, key: str = CALL_ID, seq: str = MODULE_SEQ) -> DataFrame:
    """Per module: ``copies``, ``steps``, ``masiva_lg`` and how many steps meet each predicate, the best step."""
    is_module = F.col("_module")
    return _tagged(modules, steps, key, seq).groupBy(key, seq).agg(
        F.count_if(is_module).alias("copies"), F.count_if(~is_module).alias("steps"),
        *[F.max(flag(is_module & p)).alias(n) for n, p in module_predicates().items()],
        *[F.sum(flag(~is_module & p)).alias(n) for n, p in step_predicates().items()],
        F.max(F.when(~is_module, _best(step_score(), STEP_SCORE_COLS))).alias("best_step")).where("copies > 0")


def call_values(modules: DataFrame, steps: DataFrame, key: str = CALL_ID, seq: str = MODULE_SEQ) -> DataFrame:
    """The distinct combinations of known values and predicates met in a call's modules and their
    steps: columns of the steps, NULL where a value (or a part of the document) isn't known."""
    is_module = F.col("_module")
    known = {c: all_known(DOC_COLS) for c in DOC_COLS} | {c: is_known(c) for c in STEP_SCORE_COLS}
    flags = [flag(is_module & p).alias(n) for n, p in module_predicates().items()]
    flags += [flag(~is_module & p).alias(n) for n, p in step_predicates().items()]
    rows = _tagged(modules, steps, key, seq).select(
        key, seq, *[F.when(~is_module & cond, F.col(c)).alias(c) for c, cond in known.items()], *flags, flag(is_module).alias("_m")).distinct()
    exists = F.max("_m").over(Window.partitionBy(key, seq))
    return rows.withColumn("_m", exists).where("_m > 0").drop("_m", seq).distinct()


def call_rows_and_modules(calls: DataFrame, modules: DataFrame, steps: DataFrame, key: str = KEY) -> DataFrame:
    """The second union: call rows (``_call``) with prefixed columns, and a row per module."""
    m = module_facts(modules, steps).select(
        F.col(CALL_ID).alias(key), F.lit(False).alias("_call"), (F.col("copies") * F.greatest("steps", F.lit(1))).alias("_rows"),
        *module_predicates(), *[(F.col("copies") * F.col(n)).alias(n) for n in step_predicates()], "best_step")
    return _call_rows(calls, key).unionByName(m, allowMissingColumns=True)


def call_rows_and_values(calls: DataFrame, modules: DataFrame, steps: DataFrame, key: str = KEY) -> DataFrame:
    """The second union with the values to collect: call rows, and the distinct combinations of values."""
    v = call_values(modules, steps).withColumnRenamed(CALL_ID, key).withColumn("_call", F.lit(False))
    return _call_rows(calls, key).unionByName(v, allowMissingColumns=True)


def _call_rows(calls: DataFrame, key: str) -> DataFrame:
    return calls.select(key, F.lit(True).alias("_call"), *BASE_COLUMNS, "calls_vdn_label")


def call_flags(calls: DataFrame, modules: DataFrame, steps: DataFrame, names: dict[str, str],
               key: str = KEY, by_sum: bool = False) -> DataFrame:
    """Per call id 1 if any row of the detail meets the predicate, else 0. ``names`` maps a
    predicate (``masiva_lg``, ``by_phone``, ``by_known_phone``, ``by_dni``) to its column. ``by_sum`` counts
    the rows that meet it and asks for one at least."""
    rows = call_rows_and_modules(calls, modules, steps, key)
    hit = {n: F.sum(n) if by_sum else F.max(n) for n in names}
    g = rows.groupBy(key).agg(F.count_if("_call").alias("_calls"), *[h.alias("_" + n) for n, h in hit.items()]).where("_calls > 0")
    return g.select(key, *[flag(F.col("_" + n) >= 1).alias(out) for n, out in names.items()])


def key_cardinality(calls: DataFrame, modules: DataFrame, steps: DataFrame, key: str = KEY) -> DataFrame:
    """Rows of the detail with a call id, and distinct call ids."""
    rows = call_rows_and_modules(calls, modules, steps, key).where(F.col(key).isNotNull())
    g = rows.groupBy(key).agg(F.count_if("_call").alias("_calls"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows")).where("_calls > 0")
    total = F.sum(F.col("_calls") * F.greatest("_rows", F.lit(1)))
    return g.agg(F.coalesce(total, F.lit(0)).alias(OUT["rows"]), F.count(F.lit(1)).alias(OUT["distinct_rows"]))


def best_call_row(key: str = KEY) -> Column:
    """Aggregate over call rows: the best by known phone, then the columns, descending, NULLs last."""
    return F.max(F.when(F.col("_call"), _scored_call()))


def _scored_call() -> Column:
    return _best(flag(is_known(PHONE)), BASE_COLUMNS)


def best_row(calls: DataFrame, modules: DataFrame, steps: DataFrame, key: str = KEY) -> DataFrame:
    """Per call id the detail's row with the highest completeness score, ties by the columns listed.

    A maximum of structs is sorted for, so rows are kept narrow: a call's columns are one struct before
    the union, which a module's row leaves NULL; an id without such a struct has no call."""
    m = module_facts(modules, steps).select(F.col(CALL_ID).alias(key), F.col("best_step").alias("_s"))
    rows = calls.select(key, _scored_call().alias("_c")).unionByName(m, allowMissingColumns=True)
    g = rows.groupBy(key).agg(F.max("_c").alias("_c"), F.max("_s").alias("_s")).where(F.col("_c").isNotNull())
    return g.select(key, *[F.col("_c")[c].alias(c) for c in BASE_COLUMNS], *[F.col("_s")[c].alias(c) for c in STEP_SCORE_COLS])
