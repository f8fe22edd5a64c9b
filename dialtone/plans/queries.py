"""Registered queries: every operator run over the driver's tables.

Each entry takes (spark, sf_dir) and returns a lazy DataFrame. The IVR tables
are derived from ``events`` and ``lineitem`` (``sources.bindings``), so the work
of every query grows with those tables. Array columns are rendered as text
(``array_join``) so results compare value-for-value with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import date_id
from ..operators import cleaning, facts, features as feat, profile, summary, validate
from ..operators.detail import build_detail, prefixed_calls
from ..operators.recency import recency_flags
from ..operators.sequence import row_sequence
from ..session import bound_sorts
from ..sources.bindings import ivr_tables, modules_from_lineitem
from ..sources.model import TPCH_MODEL
from ..sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _struct_text(names, field_sep):
    def fmt(x):
        return F.concat_ws(field_sep, *[x[n].cast("string") for n in names])
    return fmt


def arrays_as_text(df: DataFrame, sep: str = ",", field_sep: str = ":") -> DataFrame:
    """Render array columns as text: elements joined by ``sep``; struct elements
    as their fields joined by ``field_sep``."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            et = f.dataType.elementType
            if isinstance(et, T.StructType):
                arr = F.transform(F.col(f.name), _struct_text([x.name for x in et.fields], field_sep))
            else:
                arr = F.col(f.name).cast("array<string>")
            cols.append(F.array_join(arr, sep).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_detail(*ivr_tables(spark, sf_dir))


def call_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail's call columns. The left joins keep every call and copy its columns,
    so what reads only these and ignores repeats needs no join."""
    return prefixed_calls(ivr_tables(spark, sf_dir)[0])


def _q_detail(spark, d):
    return detail(spark, d)


def _q_date_id(spark, d):
    calls, _, _ = ivr_tables(spark, d)
    return calls.select("ivr_id", date_id("start_date").alias("start_date_id"),
                        date_id("end_date").alias("end_date_id"))


def _q_classify_label(spark, d):
    return feat.classify_label(call_rows(spark, d))


def tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(prefixed calls, modules, steps): what flags, counts and summaries aggregate without a join."""
    calls, modules, steps = ivr_tables(spark, sf_dir)
    return prefixed_calls(calls), modules, steps


def _q_flag_module(spark, d):
    return facts.call_flags(*tables(spark, d), {"masiva_lg": "masiva_lg"})


def _q_flag_step(spark, d):
    return facts.call_flags(*tables(spark, d), {"by_phone": "info_by_phone_lg"})


def _q_flag_step_sum(spark, d):
    return facts.call_flags(*tables(spark, d), {"by_dni": "info_by_dni_lg"}, by_sum=True)


def _q_flag_step_refined(spark, d):
    return facts.call_flags(*tables(spark, d), {"by_known_phone": "info_by_phone_lg"})


def _q_call_flags(spark, d):
    return facts.call_flags(*tables(spark, d), {
        "masiva_lg": "masiva_lg", "by_known_phone": "info_by_phone_lg", "by_dni": "info_by_dni_lg"})


def _q_key_cardinality(spark, d):
    return facts.key_cardinality(*tables(spark, d))


def _q_value_combinations(spark, d):
    return profile.value_combinations(detail(spark, d))


def _q_combination_coverage(spark, d):
    return profile.combination_coverage(detail(spark, d))


def _q_values_per_key_histogram(spark, d):
    return profile.values_per_key_histogram(detail(spark, d))


def _q_ranked_values(spark, d):
    return profile.ranked_values(detail(spark, d))


def _q_ranked_accounts(spark, d):
    return profile.ranked_values(detail(spark, d), cols=["billing_account_id"], min_count=1,
                                 count_name="bills_per_call")


def _q_distinct_per_group(spark, d):
    return profile.distinct_per_group(detail(spark, d))


def _q_multi_valued_keys(spark, d):
    return profile.multi_valued_keys(detail(spark, d))


def _q_multi_valued_phones(spark, d):
    return profile.multi_valued_keys(detail(spark, d), col="customer_phone",
                                     count_name="phones_per_register")


def _q_collect_structs(spark, d):
    return arrays_as_text(feat.collect_structs(detail(spark, d)))


def _q_collect_parallel(spark, d):
    return arrays_as_text(feat.collect_parallel(detail(spark, d)))


def _q_collect_structs_elements(spark, d):
    """F2 with its arrays as arrays: a row per place in the array, and the array's length."""
    got = feat.collect_structs(detail(spark, d))
    return got.select("calls_ivr_id", F.size("documents_of_call").cast("bigint").alias("length"),
                      F.posexplode("documents_of_call").alias("place", "e")).select("calls_ivr_id", "length", "place", "e.*")


def _q_collect_parallel_elements(spark, d):
    """the places of both arrays side by side."""
    got = feat.collect_parallel(detail(spark, d))
    return got.select("calls_ivr_id", F.size("documents_types").cast("bigint").alias("n_types"),
                      F.size("document_identifications").cast("bigint").alias("n_ids"),
                      F.posexplode(F.arrays_zip("documents_types", "document_identifications")).alias("place", "e")).select(
        "calls_ivr_id", "n_types", "n_ids", "place", "e.*")


def _q_collect_values(spark, d):
    return arrays_as_text(feat.collect_values(detail(spark, d)))


def _q_collect_values_multi(spark, d):
    return arrays_as_text(feat.collect_values(detail(spark, d), min_count=2))


def _q_recency_flags(spark, d):
    return recency_flags(call_rows(spark, d))


def _q_recency_report(spark, d):
    """The repeat flags in the source's order (call id, phone), each row with its place in the report."""
    flags = recency_flags(call_rows(spark, d)).select("calls_ivr_id", "calls_phone_number", "calls_start_date",
                                                      "repeated_phone_24H", "cause_recall_phone_24H")
    return row_sequence(flags, ["calls_ivr_id", "calls_phone_number", "calls_start_date"], name="place")


def _q_base_by_max(spark, d):
    return summary.base_by_max(call_rows(spark, d))


def _q_best_row(spark, d):
    bound_sorts(spark)
    return facts.best_row(*tables(spark, d))


def _q_summary(method):
    def q(spark, d):
        return arrays_as_text(summary.summary_from_tables(*tables(spark, d), method=method))
    return q


def _q_clean_int(spark, d):
    det = detail(spark, d).select("calls_ivr_id", "module_sequece", "step_sequence",
                                  "calls_steps_module")
    return cleaning.clean_int_columns(det, ["module_sequece", "step_sequence", "calls_steps_module"])


def _q_clean_int_sql(spark, d):
    from ..functions.sql_functions import register_clean_int
    name = register_clean_int(spark)
    det = detail(spark, d).select("calls_ivr_id", "module_sequece", "step_sequence",
                                  "calls_steps_module")
    return det.select("calls_ivr_id", *[F.call_function(name, F.col(c)).alias(c)
                                        for c in ("module_sequece", "step_sequence",
                                                  "calls_steps_module")])


def _q_drop_unknown(spark, d):
    return cleaning.drop_unknown(detail(spark, d),
                                 ["document_type", "document_identification", "customer_phone"])


IVR_QUERIES: dict[str, Query] = {
    "ivr_detail": _q_detail,
    "date_id": _q_date_id,
    "classify_label": _q_classify_label,
    "flag_module": _q_flag_module,
    "flag_step": _q_flag_step,
    "flag_step_sum": _q_flag_step_sum,
    "flag_step_refined": _q_flag_step_refined,
    "call_flags": _q_call_flags,
    "key_cardinality": _q_key_cardinality,
    "value_combinations": _q_value_combinations,
    "combination_coverage": _q_combination_coverage,
    "values_per_key_histogram": _q_values_per_key_histogram,
    "ranked_values": _q_ranked_values,
    "ranked_accounts": _q_ranked_accounts,
    "distinct_per_group": _q_distinct_per_group,
    "multi_valued_keys": _q_multi_valued_keys,
    "multi_valued_phones": _q_multi_valued_phones,
    "collect_structs": _q_collect_structs,
    "collect_parallel": _q_collect_parallel,
    "collect_structs_elements": _q_collect_structs_elements,
    "collect_parallel_elements": _q_collect_parallel_elements,
    "collect_values": _q_collect_values,
    "collect_values_multi": _q_collect_values_multi,
    "recency_flags": _q_recency_flags,
    "recency_report": _q_recency_report,
    "base_by_max": _q_base_by_max,
    "best_row": _q_best_row,
    "summary_max": _q_summary("max"),
    "summary_best_row": _q_summary("best_row"),
    "clean_int": _q_clean_int,
    "clean_int_sql": _q_clean_int_sql,
    "drop_unknown": _q_drop_unknown,
}

ALL_QUERIES: dict[str, Query] = {**IVR_QUERIES}


# --- table model and validation (V1-V8) over the driver's tables --------------------

NOT_NULL_DETAIL_COLS = ["calls_vdn_label", "module_sequece", "step_sequence", "document_type",
                        "customer_phone", "step_description_error"]
LENGTH_LIMITS_DETAIL = {"calls_phone_number": 2, "document_identification": 3,
                        "billing_account_id": 4, "step_name": 20}


def _q_typed_load(spark, d):
    """A table read with its declared schema instead of the files' own."""
    declared = [spec for spec in TPCH_MODEL if spec.schema is not None]
    return validate.read_model(spark, d, declared)["orders"]


def _q_check_not_null(spark, d):
    return validate.check_not_null(detail(spark, d), NOT_NULL_DETAIL_COLS)


def _q_check_unique(spark, d):
    return validate.check_unique(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _q_check_primary_key(spark, d):
    return validate.check_unique(read_table(spark, d, "orders"), ["o_orderkey"], allow_null=False)


def _q_check_primary_key_detail(spark, d):
    # the call id is no key of the detail; calls without a step have no step key at all
    return validate.check_unique(detail(spark, d), ["step_sequence"], allow_null=False)


def _q_check_foreign_key(spark, d):
    # orders whose key has no line item (the reverse of the declared direction)
    return validate.check_foreign_key(read_table(spark, d, "orders"), ["o_orderkey"],
                                      read_table(spark, d, "lineitem"), ["l_orderkey"])


def _q_check_foreign_key_lineitem(spark, d):
    return validate.check_foreign_key(read_table(spark, d, "lineitem"), ["l_orderkey"],
                                      read_table(spark, d, "orders"), ["o_orderkey"])


def _q_check_domain(spark, d):
    return validate.check_domain(read_table(spark, d, "events"), "event_type",
                                 ["click", "view", "purchase"])


def _q_check_length(spark, d):
    return validate.check_length(detail(spark, d), LENGTH_LIMITS_DETAIL)


def _q_assign_key(spark, d):
    mods = modules_from_lineitem(read_table(spark, d, "lineitem"))
    return validate.assign_key(mods, "module_id",
                               ["ivr_id", "module_sequece", "module_name", "module_result"])


def _q_assign_key_continued(spark, d):
    """Half of the modules have a key already; the others go on above its maximum."""
    mods = modules_from_lineitem(read_table(spark, d, "lineitem"))
    keyed = mods.withColumn("module_id", F.when(
        F.col("module_sequece") % 2 == 0, (F.col("ivr_id") * 10 + F.col("module_sequece")).cast("bigint")))
    return validate.assign_key(keyed, "module_id",
                               ["ivr_id", "module_sequece", "module_name", "module_result"])


def _q_validate_model(spark, d):
    tables = {t.name: read_table(spark, d, t.name) for t in TPCH_MODEL}
    for spec in TPCH_MODEL:
        for fk in spec.foreign_keys:
            tables.setdefault(fk.parent, read_table(spark, d, fk.parent))
    return validate.validate_model(tables, TPCH_MODEL)


MODEL_QUERIES: dict[str, Query] = {
    "typed_load": _q_typed_load,
    "check_not_null": _q_check_not_null,
    "check_unique": _q_check_unique,
    "check_primary_key": _q_check_primary_key,
    "check_primary_key_detail": _q_check_primary_key_detail,
    "check_foreign_key": _q_check_foreign_key,
    "check_foreign_key_lineitem": _q_check_foreign_key_lineitem,
    "check_domain": _q_check_domain,
    "check_length": _q_check_length,
    "assign_key": _q_assign_key,
    "assign_key_continued": _q_assign_key_continued,
    "validate_model": _q_validate_model,
}

ALL_QUERIES.update(MODEL_QUERIES)
