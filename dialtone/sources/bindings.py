"""Bindings from the driver's TPC-H-like tables to the three IVR base tables.

The driver ships no IVR-shaped table, so calls are derived from ``events`` and
modules/steps from ``lineitem``. Everything is a lazy projection over the
parquet scan: the work grows with the tables and Catalyst prunes unused columns.

calls  : one row per event (``event_id`` is the call id, ``user_id`` the phone)
modules: one row per distinct (order, line, return flag) of ``lineitem``
steps  : one row per ``lineitem`` row
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table
from .ivr_schema import CALL_COLUMNS, MODULE_COLUMNS, STEP_COLUMNS, SENTINEL

# --- fixed values: how driver values map to IVR values ------------------------------
VDN_LABEL_OF_EVENT = {"click": "atc_web", "error": "TECH_L2", "view": "absorption"}
VDN_LABEL_NULL_EVENT = "purchase"
PHONE_UNKNOWN_EVERY = 25          # user_id % 25 = 0 -> phone 'UNKNOWN'
MASS_OUTAGE_RETURN_FLAG = "R"     # module AVERIA_MASIVA
STEP_NAME_OF_RETURN_FLAG = {"A": "CUSTOMERINFOBYPHONE.TX", "N": "CUSTOMERINFOBYDNI.TX"}
STEP_OK_TAX_ABOVE = 0.04


def _unknown_unless(cond: Column, value: Column) -> Column:
    return F.when(cond, value.cast("string")).otherwise(F.lit(SENTINEL))


def calls_from_events(events: DataFrame) -> DataFrame:
    e = events
    label = F.when(F.col("event_type") == VDN_LABEL_NULL_EVENT, F.lit(None).cast("string"))
    for ev, lab in VDN_LABEL_OF_EVENT.items():
        label = label.when(F.col("event_type") == ev, F.lit(lab))
    label = label.otherwise(F.col("event_type"))
    uid = F.col("user_id")
    return e.select(
        F.col("event_id").cast("double").alias("ivr_id"),
        F.when(uid % PHONE_UNKNOWN_EVERY == 0, F.lit(SENTINEL))
         .otherwise(uid.cast("string")).alias("phone_number"),
        F.col("event_type").alias("ivr_result"),
        label.alias("vdn_label"),
        F.col("ts").alias("start_date"),
        F.timestamp_add("MINUTE", F.floor("value").cast("int"), F.col("ts")).alias("end_date"),
        F.floor(F.col("value") * 60).cast("bigint").alias("total_duration"),
        F.when(uid % 3 == 0, "RESIDENTIAL").when(uid % 3 == 1, "SMALL_BUSINESS")
         .otherwise("CORPORATE").alias("customer_segment"),
        F.when(uid % 5 == 0, "ENGLISH").otherwise("SPANISH").alias("ivr_language"),
        (F.col("event_id") % 7).cast("int").alias("steps_module"),
        F.upper("event_type").alias("module_aggregation"),
    ).select(*CALL_COLUMNS)


def modules_from_orders(orders: DataFrame) -> DataFrame:
    """A header module (sequence 0) per customer with orders; it has no steps, and calls
    beyond the customers' keys keep having no module at all."""
    return orders.select("o_custkey").distinct().select(
        F.col("o_custkey").cast("double").alias("ivr_id"),
        F.lit(0).cast("int").alias("module_sequece"),
        F.lit("HEADER").alias("module_name"),
        F.lit(0).cast("bigint").alias("module_duration"),
        F.lit("OK").alias("module_result"),
    ).select(*MODULE_COLUMNS)


def modules_from_lineitem(lineitem: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_linenumber", "l_returnflag").distinct()
    return li.select(
        F.col("l_orderkey").cast("double").alias("ivr_id"),
        F.col("l_linenumber").alias("module_sequece"),
        F.when(F.col("l_returnflag") == MASS_OUTAGE_RETURN_FLAG, "AVERIA_MASIVA")
         .otherwise("OTHER").alias("module_name"),
        (F.col("l_linenumber") * 30).cast("bigint").alias("module_duration"),
        F.when(F.col("l_returnflag") == "N", "OK").otherwise("KO").alias("module_result"),
    ).select(*MODULE_COLUMNS)


def steps_from_lineitem(lineitem: DataFrame) -> DataFrame:
    li = lineitem
    name = F.lit("X")
    for flag, step in reversed(list(STEP_NAME_OF_RETURN_FLAG.items())):
        name = F.when(F.col("l_returnflag") == flag, step).otherwise(name)
    ok = F.col("l_tax") > F.lit(STEP_OK_TAX_ABOVE)
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    return li.select(
        F.col("l_orderkey").cast("double").alias("ivr_id"),
        F.col("l_linenumber").alias("module_sequece"),
        (part % 10).cast("int").alias("step_sequence"),
        name.alias("step_name"),
        F.when(ok, "OK").otherwise("KO").alias("step_result"),
        F.when(ok, F.lit(None).cast("string")).otherwise("ERROR").alias("step_description_error"),
        F.when(supp % 3 == 0, F.lit(SENTINEL)).otherwise(F.lit("DNI")).alias("document_type"),
        _unknown_unless(part % 3 != 0, part).alias("document_identification"),
        _unknown_unless(supp % 10 == 0, supp).alias("customer_phone"),
        _unknown_unless(part % 4 == 0, part).alias("billing_account_id"),
    ).select(*STEP_COLUMNS)


def ivr_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, modules, steps) derived from the driver tables in ``sf_dir``."""
    events = read_table(spark, sf_dir, "events")
    lineitem = read_table(spark, sf_dir, "lineitem")
    modules = modules_from_lineitem(lineitem)
    headers = modules_from_orders(read_table(spark, sf_dir, "orders"))
    headers = headers.select(*[F.col(f.name).cast(f.dataType) for f in modules.schema.fields])
    return calls_from_events(events), modules.unionByName(headers), steps_from_lineitem(lineitem)
