import pytest
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from dialtone.operators.sequence import rank_within, row_sequence
from dialtone.operators.validate import assign_key

from conftest import rows


def test_rank_within_matches_window_with_hot_key(spark):
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        k = "hot" if rnd.random() < 0.34 else (None if rnd.random() < 0.05 else f"k{rnd.randint(0, 200)}")
        data.append((k, rnd.randint(0, 10 ** 6), f"p{i}"))
    df = spark.createDataFrame(data, "k string, v int, payload string").distinct()
    ours = rank_within(df, "k", ["v", "payload"], count_name="n")
    w = Window.partitionBy("k").orderBy("v", "payload")
    ref = df.select("*", F.row_number().over(w).alias("rn"),
                    F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"))
    assert rows(ours.select("k", "v", "payload", "rn", "n")) == rows(ref.select("k", "v", "payload", "rn", "n"))


def test_row_sequence_dense_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("x"), F.lit("a").alias("tag"))
    got = sorted((r.x, r.seq) for r in row_sequence(df, ["x"], start=100).collect())
    assert [s for _, s in got] == list(range(101, 5101))


def test_assign_key_keeps_existing_and_goes_above_max(spark):
    df = spark.createDataFrame([(5, "b"), (None, "c"), (2, "a"), (None, "a"), (None, "z")],
                               "id int, name string")
    got = sorted((r.name, r.id) for r in assign_key(df, "id", ["name"]).collect())
    assert got == [("a", 2), ("a", 6), ("b", 5), ("c", 7), ("z", 8)]
    empty_start = assign_key(spark.createDataFrame([(None, "q")], "id int, name string"), "id", ["name"])
    assert empty_start.first().id == 1


def test_assign_key_names_an_unorderable_column(spark):
    df = spark.sql("SELECT 1 AS a, map('x', 1) AS m, CAST(NULL AS BIGINT) AS id")
    with pytest.raises(ValueError, match="m"):
        assign_key(df, "id", ["a"])


def test_assign_key_with_existing_keys_from_a_shuffle(spark):
    """Existing keys come out of an aggregate (a shuffle read in the same final
    stage as the numbered rows): new keys must still be unique, dense and in
    order, whatever adaptive coalescing does to the other shuffle."""
    base = spark.range(0, 20000).select((F.col("id") % 7919).alias("k"), (F.col("id") * 31 % 10007).alias("v"))
    agg = base.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    df = agg.select(F.when(F.col("k") % 2 == 0, F.col("k")).alias("id"), "v", "k")
    out = assign_key(df, "id", ["v", "k"]).collect()
    new = sorted((r.v, r.k, r.id) for r in out if r.k % 2 == 1)
    start = 7918  # max existing even key
    assert [x[2] for x in new] == list(range(start + 1, start + 1 + len(new)))
    assert max(r.id for r in out if r.k % 2 == 0) < min(x[2] for x in new)


def test_rank_within_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    keys = st.sampled_from(["a", "b", "hot", None])
    rows_st = st.lists(st.tuples(keys, st.integers(-5, 50)), min_size=1, max_size=120, unique=True)

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(rows_st)
    def check(data):
        df = spark.createDataFrame(data, "k string, v int")
        ours = rank_within(df, "k", ["v"], count_name="n")
        w = Window.partitionBy("k").orderBy("v")
        ref = df.select("*", F.row_number().over(w).alias("rn"),
                        F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"))
        assert rows(ours.select("k", "v", "rn", "n")) == rows(ref.select("k", "v", "rn", "n"))

    check()


def test_numbering_without_order_makes_no_ranges(spark):
    df = spark.range(0, 5000, 1, 8).select((F.col("id") % 50).alias("x"), F.lit(None).cast("bigint").alias("key"))
    df = df.unionByName(spark.createDataFrame([(-1, 1000)], "x bigint, key bigint"))
    out = assign_key(df, "key")
    got = sorted(r.key for r in out.collect())
    assert got == [1000, *range(1001, 6001)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "RoundRobinPartitioning" in plan
    # the same rows get the same numbers when the work is done again
    assert rows(out) == rows(assign_key(df, "key"))
