import pytest
from datetime import datetime

from pyspark.sql import functions as F

from dialtone.functions import (
    classify_label, clean_int, date_id, is_known, create_clean_int, drop_clean_int, register_clean_int, whole_hours_between,
)


def test_classify_label_rules(spark):
    labels = ["ATC_web", "atc", "tech_l2", "TECHNICAL", "ABSORPTION", "absorption",
              "Absorption2", "other", None, "xATC"]
    df = spark.createDataFrame([(x,) for x in labels], "l string")
    got = dict(df.select("l", classify_label("l").alias("c")).collect())
    assert got == {"ATC_web": "FRONT", "atc": "FRONT", "tech_l2": "TECH", "TECHNICAL": "TECH",
                   "ABSORPTION": "ABSORPTION", "absorption": "ABSORPTION",
                   "Absorption2": "RESTO", "other": "RESTO", None: "RESTO", "xATC": "RESTO"}


def test_first_rule_wins(spark):
    df = spark.createDataFrame([("ATCTECH",)], "l string")
    rules = [("prefix", "ATC", "A"), ("prefix", "ATCT", "B")]
    assert df.select(classify_label("l", rules, "Z")).first()[0] == "A"


def test_date_id(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 9, 23, 59, 59),), (None,)], "t timestamp")
    assert [r[0] for r in df.select(date_id("t")).collect()] == ["20240309", None]


def test_whole_hours_truncate(spark):
    a = datetime(2024, 1, 1, 8, 0, 0)
    df = spark.createDataFrame([(a, datetime(2024, 1, 2, 7, 59, 59)),
                                (a, datetime(2024, 1, 2, 8, 0, 0)),
                                (a, datetime(2024, 1, 1, 8, 59, 59))], "a timestamp, b timestamp")
    got = [r[0] for r in df.select(whole_hours_between("b", "a")).collect()]
    assert got == [23, 24, 0]


def test_whole_hours_on_timestamp_ntz(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 08:00:00' a, TIMESTAMP_NTZ'2024-01-02 07:59:59' b")
    assert df.select(whole_hours_between("b", "a")).first()[0] == 23


def test_is_known(spark):
    df = spark.createDataFrame([("x",), ("UNKNOWN",), (None,), ("unknown",)], "v string")
    got = [r[0] for r in df.select(is_known("v")).collect()]
    assert got == [True, False, False, True]


def test_clean_int_column_and_sql_function_agree(spark):
    df = spark.createDataFrame([(None,), (5,), (-1,), (0,)], "x int")
    name = register_clean_int(spark)
    got = df.select(clean_int("x").alias("a"), F.call_function(name, F.col("x")).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(-99999, -99999), (5, 5), (-1, -1), (0, 0)]
    assert spark.sql(f"SELECT {name}(NULL), {name}(7)").first() == (-99999, 7)


def test_catalog_function_is_created_replaced_used_and_dropped(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tools")
    spark.sql("CREATE OR REPLACE FUNCTION tools.clean_int(x BIGINT) RETURNS BIGINT RETURN 1")
    name = create_clean_int(spark, "tools")
    df = spark.sql(f"SELECT {name}(NULL) AS a, {name}(id) AS b FROM range(3)")
    assert sorted(tuple(r) for r in df.collect()) == [(-99999, 0), (-99999, 1), (-99999, 2)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "clean_int" not in plan and "Python" not in plan   # inlined
    drop_clean_int(spark, "tools")
    with pytest.raises(Exception, match="UNRESOLVED_ROUTINE"):
        spark.sql(f"SELECT {name}(1)").collect()


def test_scale_conf_bounds():
    from dialtone.session import scale_conf
    big = scale_conf(100 * 10 ** 12, 8000)
    assert big["spark.sql.shuffle.partitions"] == "65536"   # partitions grow, not their number
    assert int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) * 65536 >= 100 * 10 ** 12
    assert big["spark.sql.files.maxPartitionBytes"] == str(1024 ** 3)
    assert scale_conf(10 ** 13, 8)["spark.sql.shuffle.partitions"] == "37253"
    small = scale_conf(10 ** 6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    mid = scale_conf(512 * 1024 * 1024 * 100, 8)
    assert mid["spark.sql.shuffle.partitions"] == "200"
