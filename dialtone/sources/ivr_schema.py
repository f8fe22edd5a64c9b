"""Column names and types of the three IVR base tables and of the derived tables.

Fixed values: these names must equal the source data model so that detail and
summary tables keep their published column names. Note the original spelling
``module_sequece`` of the module sequence column.
"""

from pyspark.sql import types as T

# --- fixed values: IVR column names -------------------------------------------------
CALL_ID = "ivr_id"
MODULE_SEQ = "module_sequece"
SENTINEL = "UNKNOWN"

CALL_COLUMNS = [
    "ivr_id", "phone_number", "ivr_result", "vdn_label", "start_date", "end_date",
    "total_duration", "customer_segment", "ivr_language", "steps_module",
    "module_aggregation",
]
MODULE_COLUMNS = ["ivr_id", "module_sequece", "module_name", "module_duration", "module_result"]
STEP_COLUMNS = [
    "ivr_id", "module_sequece", "step_sequence", "step_name", "step_result",
    "step_description_error", "document_type", "document_identification",
    "customer_phone", "billing_account_id",
]

DETAIL_COLUMNS = [
    "calls_ivr_id", "calls_phone_number", "calls_ivr_result", "calls_vdn_label",
    "calls_start_date", "calls_start_date_id", "calls_end_date", "calls_end_date_id",
    "calls_total_duration", "calls_customer_segment", "calls_ivr_language",
    "calls_steps_module", "calls_module_aggregation", "module_sequece", "module_name",
    "module_duration", "module_result", "step_sequence", "step_name", "step_result",
    "step_description_error", "document_type", "document_identification",
    "customer_phone", "billing_account_id",
]

SUMMARY_COLUMNS = [
    "ivr_id", "phone_number", "ivr_result", "vdn_aggregation", "start_date", "end_date",
    "total_duration", "customer_segment", "ivr_language", "steps_module",
    "module_aggregation", "document_type", "document_identification", "customer_phone",
    "billing_account_id", "masiva_lg", "info_by_phone_lg", "info_by_dni_lg",
    "repeated_phone_24H", "cause_recall_24H",
]

# Per-call pass-through columns of the summary base (``calls_`` prefix dropped on output).
BASE_COLUMNS = [
    "calls_phone_number", "calls_ivr_result", "calls_start_date", "calls_end_date",
    "calls_total_duration", "calls_customer_segment", "calls_ivr_language",
    "calls_steps_module", "calls_module_aggregation",
]

# --- fixed values: output column names of the profile and feature queries ---------
OUT = {
    "rows": "total_registros",
    "distinct_rows": "total_registros_unicos",
    "repeats": "number_repeticiones",
    "distinct_keys": "num_unique_calls",
    "combinations": "total_combinations",
    "values_per_key": "num_docs",
    "keys_per_count": "number_calls",
    "docs_per_call": "docs_per_call",
    "documents_of_call": "documents_of_call",
    "document_types": "documents_types",
    "document_ids": "document_identifications",
    "phones_per_register": "phones_per_register",
    "bills_per_call": "bills_per_call",
    "bills_per_register": "bills_per_register",
    "label_class": "vdn_aggregation",
    "mass_outage": "masiva_lg",
    "info_by_phone": "info_by_phone_lg",
    "info_by_dni": "info_by_dni_lg",
    "repeated": "repeated_phone_24H",
    "recall": "cause_recall_phone_24H",
}

# --- fixed values: step and module names used by the flags -------------------------
MODULE_MASS_OUTAGE = "AVERIA_MASIVA"
STEP_INFO_BY_PHONE = "CUSTOMERINFOBYPHONE.TX"
STEP_INFO_BY_DNI = "CUSTOMERINFOBYDNI.TX"
STEP_OK = "OK"

# --- fixed values: label classes (first match wins, compared upper-cased) ----------
# (kind, pattern, class): "prefix" matches the start of the label, "exact" all of it.
LABEL_RULES = [
    ("prefix", "ATC", "FRONT"),
    ("prefix", "TECH", "TECH"),
    ("exact", "ABSORPTION", "ABSORPTION"),
]
LABEL_DEFAULT = "RESTO"

# Declared schemas of the base tables, for typed reads of real IVR extracts.
CALLS_SCHEMA = T.StructType([
    T.StructField("ivr_id", T.DoubleType()),
    T.StructField("phone_number", T.StringType()),
    T.StructField("ivr_result", T.StringType()),
    T.StructField("vdn_label", T.StringType()),
    T.StructField("start_date", T.TimestampType()),
    T.StructField("end_date", T.TimestampType()),
    T.StructField("total_duration", T.LongType()),
    T.StructField("customer_segment", T.StringType()),
    T.StructField("ivr_language", T.StringType()),
    T.StructField("steps_module", T.IntegerType()),
    T.StructField("module_aggregation", T.StringType()),
])
MODULES_SCHEMA = T.StructType([
    T.StructField("ivr_id", T.DoubleType()),
    T.StructField("module_sequece", T.IntegerType()),
    T.StructField("module_name", T.StringType()),
    T.StructField("module_duration", T.LongType()),
    T.StructField("module_result", T.StringType()),
])
STEPS_SCHEMA = T.StructType([
    T.StructField("ivr_id", T.DoubleType()),
    T.StructField("module_sequece", T.IntegerType()),
    T.StructField("step_sequence", T.IntegerType()),
    T.StructField("step_name", T.StringType()),
    T.StructField("step_result", T.StringType()),
    T.StructField("step_description_error", T.StringType()),
    T.StructField("document_type", T.StringType()),
    T.StructField("document_identification", T.StringType()),
    T.StructField("customer_phone", T.StringType()),
    T.StructField("billing_account_id", T.StringType()),
])

# Schema of the detail table (for streaming reads of detail files).
DETAIL_SCHEMA = T.StructType(
    [T.StructField("calls_" + f.name, f.dataType) for f in CALLS_SCHEMA.fields[:5]]
    + [T.StructField("calls_start_date_id", T.StringType()),
       T.StructField("calls_end_date", T.TimestampType()),
       T.StructField("calls_end_date_id", T.StringType())]
    + [T.StructField("calls_" + f.name, f.dataType) for f in CALLS_SCHEMA.fields[6:]]
    + [f for f in MODULES_SCHEMA.fields[1:]]
    + [f for f in STEPS_SCHEMA.fields[2:]])
assert [f.name for f in DETAIL_SCHEMA.fields] == DETAIL_COLUMNS
