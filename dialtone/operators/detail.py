"""Detail table: calls, modules and steps flattened into one row per
(call, module, step) (operators D1-D3).

calls LEFT JOIN modules ON call id, then LEFT JOIN steps ON the *module's*
(call id, sequence). A call without modules survives with NULL module and step
columns; a step whose module is missing is lost, as in the source model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import date_id
from ..sources.ivr_schema import CALL_COLUMNS, CALL_ID, DETAIL_COLUMNS, MODULE_SEQ
from .joins import Skew, hot_keys, left_join


def prefixed_calls(calls: DataFrame, key: str = CALL_ID, prefix: str = "calls_") -> DataFrame:
    """Call-level projection with prefixed names and the two date ids."""
    cols = []
    for c in CALL_COLUMNS:
        cols.append(F.col(c).alias(prefix + c))
        if c in ("start_date", "end_date"):
            cols.append(date_id(c).alias(f"{prefix}{c}_id"))
    return calls.select(*cols)


def build_detail(calls: DataFrame, modules: DataFrame, steps: DataFrame,
                 key: str = CALL_ID, seq: str = MODULE_SEQ, skew: Skew | None = Skew()) -> DataFrame:
    """The 25-column detail table, two left joins.

    ``skew`` looks for call ids that are hot in modules and (call id, sequence) pairs that are hot
    in steps before planning, one narrow aggregate each, and salts those only; None skips it.
    """
    c = prefixed_calls(calls, key)
    hot_modules = hot_keys(modules, [key], skew) if skew else None
    hot_steps = hot_keys(steps, [key, seq], skew) if skew else None
    m = modules.select(*[F.col(x).alias("_m_" + x) if x in (key, seq) else F.col(x)
                         for x in modules.columns])
    s = steps.select(*[F.col(x).alias("_s_" + x) if x in (key, seq) else F.col(x)
                       for x in steps.columns])
    cm = left_join(c, m, [f"calls_{key}"], [f"_m_{key}"], hot_modules)
    # The module's own id equals the call id whenever a module matched and is
    # NULL otherwise, so joining steps on the call id is the same join.
    cms = left_join(cm, s, [f"calls_{key}", f"_m_{seq}"], [f"_s_{key}", f"_s_{seq}"], hot_steps)
    return cms.withColumnRenamed(f"_m_{seq}", seq).select(*DETAIL_COLUMNS)


def detail_from_driver(spark, sf_dir: str, skew: Skew | None = Skew()) -> DataFrame:
    from ..sources.bindings import ivr_tables
    return build_detail(*ivr_tables(spark, sf_dir), skew=skew)
