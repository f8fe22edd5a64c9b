"""Hot keys: one call id owning a third of all module rows, or one module owning a third of all
step rows, is dealt over many tasks; a plain left outer join leaves it in one."""
import pytest
from pyspark.sql import functions as F

from dialtone.operators.detail import build_detail
from dialtone.operators.joins import Skew, hot_keys
from dialtone.sources.ivr_schema import MODULES_SCHEMA, STEPS_SCHEMA

from conftest import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}
SKEW = Skew(least_rows=1000, rows_per_salt=500)


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _calls(spark, n):
    return spark.range(0, n).select(
        F.col("id").cast("double").alias("ivr_id"), F.lit("600").alias("phone_number"),
        F.lit("r").alias("ivr_result"), F.lit("ATC").alias("vdn_label"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("start_date"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("end_date"),
        F.lit(1).cast("long").alias("total_duration"), F.lit("a").alias("customer_segment"),
        F.lit("es").alias("ivr_language"), F.lit(1).alias("steps_module"),
        F.lit("m").alias("module_aggregation"))


def hot_modules(spark, n):
    """A third of all module rows belong to call 7; call 3 has none."""
    mods = spark.range(0, 3 * n).select(
        F.when(F.col("id") < n, F.lit(7.0)).otherwise((F.col("id") % n).cast("double")).alias("ivr_id"),
        F.col("id").cast("int").alias("module_sequece"), F.lit("OTHER").alias("module_name"),
        F.lit(1).cast("long").alias("module_duration"), F.lit("OK").alias("module_result"))
    return _calls(spark, n), mods.where("ivr_id <> 3"), spark.createDataFrame([], STEPS_SCHEMA)


def hot_steps(spark, n):
    """A third of all step rows belong to module (7, 1); half of them are equal rows."""
    mods = spark.range(0, n).select(
        F.col("id").cast("double").alias("ivr_id"), F.lit(1).alias("module_sequece"), F.lit("OTHER").alias("module_name"),
        F.lit(1).cast("long").alias("module_duration"), F.lit("OK").alias("module_result"))
    hot = F.col("id") < n
    steps = spark.range(0, 3 * n, 1, 8).select(
        F.when(hot, F.lit(7.0)).otherwise((F.col("id") % n).cast("double")).alias("ivr_id"), F.lit(1).alias("module_sequece"),
        F.when(hot & (F.col("id") % 2 == 0), 1).otherwise(F.col("id")).cast("int").alias("step_sequence"),
        *[F.lit("x").alias(f.name) for f in STEPS_SCHEMA.fields[3:]])
    return _calls(spark, n), mods.where("ivr_id <> 5"), steps


def largest_share(df):
    """The most rows that one task of the last join puts out, of all."""
    got = [r[0] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).select("n").collect()]
    return max(got) / sum(got)


@pytest.mark.parametrize("frames", [hot_modules, hot_steps])
def test_hot_keys_are_dealt_over_tasks(skew_conf, frames):
    f = frames(skew_conf, 20_000)
    keep = ["calls_ivr_id", "module_sequece", "step_sequence"]
    plain = largest_share(build_detail(*f, skew=None).select(*keep))
    safe = largest_share(build_detail(*f, skew=SKEW).select(*keep))
    assert plain > 0.33 and safe < 0.2


@pytest.mark.parametrize("frames", [hot_modules, hot_steps])
def test_salted_join_gives_the_same_rows(skew_conf, frames):
    f = frames(skew_conf, 2000)
    columns = ["calls_ivr_id", "module_sequece", "module_name", "step_sequence", "step_name"]
    salted = build_detail(*f, skew=SKEW)
    assert "_lsalt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert rows(salted.select(*columns)) == rows(build_detail(*f, skew=None).select(*columns))


def test_no_hot_key_is_a_plain_join(skew_conf):
    f = hot_modules(skew_conf, 500)
    assert hot_keys(f[1], ["ivr_id"], Skew()) is None
    assert hot_keys(f[2], ["ivr_id", "module_sequece"], SKEW) is None
    assert hot_keys(skew_conf.createDataFrame([(None, 1, "x", 1, "y")] * 5, MODULES_SCHEMA), ["ivr_id"], Skew(least_rows=1, factor=0)) is None
    plan = build_detail(*f)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2 and "_lsalt" not in plan
