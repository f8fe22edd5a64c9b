"""Plan-shape checks: what must hold for the plans to scale."""
import os

import pytest

from dialtone.operators.cleaning import drop_unknown
from dialtone.operators import facts
from dialtone.operators.detail import build_detail, prefixed_calls
from dialtone.plans import ivr_jobs
from dialtone.operators.joins import Skew
from dialtone.operators.recency import recency_flags
from dialtone.plans.queries import call_rows
from dialtone.session import SORTED_BYTES
from dialtone.sources import versions
from dialtone.plans.queries import ALL_QUERIES

from fixtures import ivr_frames

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sentinel_filter_reaches_parquet_scan(spark, tmp_path):
    det = build_detail(*ivr_frames(spark))
    path = os.path.join(str(tmp_path), "detail")
    versions.save_table(det, path, [ivr_jobs.DETAIL_PARTITION])
    q = drop_unknown(ivr_jobs.read_detail(spark, path), ["document_type"]).select("calls_ivr_id")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(document_type), Not(EqualTo(document_type,UNKNOWN))]" in plan
    assert "ReadSchema: struct<calls_ivr_id:double,document_type:string>" in plan


#: scans and joins of a query's plan: calls, modules (two tables) and steps are four; the repeat flags read the calls again
SHAPES = {"ivr_detail": (4, 2), "clean_int": (4, 2), "check_not_null": (4, 2), "check_length": (4, 2),
          "summary_max": (5, 0), "summary_best_row": (5, 0), "call_flags": (4, 0), "flag_module": (4, 0),
          "flag_step": (4, 0), "flag_step_sum": (4, 0), "flag_step_refined": (4, 0), "key_cardinality": (4, 0), "best_row": (4, 0),
          "recency_flags": (1, 0), "classify_label": (1, 0), "base_by_max": (1, 0), "validate_model": (8, 0)}


@pytest.mark.parametrize("name", SHAPES)
def test_scans_and_joins(spark, name):
    plan = ALL_QUERIES[name](spark, SF)._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    joins = text.count("Join ")
    assert (plan.executedPlan().toString().count("FileScan"), joins) == SHAPES[name]


def test_sorted_rows_and_partitions_stay_small(spark):
    """best_row sorts whole partitions: its rows hold a call's columns once, its partitions are bounded."""
    calls, mods, steps = ivr_frames(spark)
    plan = facts.best_row(prefixed_calls(calls), mods, steps)._jdf.queryExecution().analyzed()
    unions = [n for n in _nodes(plan) if n.nodeName() == "Union"]
    assert len(unions) == 2 and unions[0].output().size() == 3

    before = {k: spark.conf.get(k) for k in SORTED_BYTES}
    try:
        for k in SORTED_BYTES:
            spark.conf.set(k, "128MB")
        ALL_QUERIES["best_row"](spark, SF)
        assert {k: int(spark.conf.get(k)) for k in SORTED_BYTES} == SORTED_BYTES
        for k in SORTED_BYTES:
            spark.conf.set(k, "1m")  # a session with smaller ones keeps them
        ALL_QUERIES["best_row"](spark, SF)
        assert {spark.conf.get(k) for k in SORTED_BYTES} == {"1m"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _nodes(plan):
    children = plan.children()
    return [plan, *(n for i in range(children.size()) for n in _nodes(children.apply(i)))]


def test_no_query_uses_python_or_cross_products(spark):
    for name, q in ALL_QUERIES.items():
        plan = _plan(q(spark, SF))
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def _final(df):
    df.collect()
    return _plan(df).split("\n+- == Initial Plan ==")[0]


def test_numbering_reads_one_range_exchange(spark):
    """Distributed numbering is consistent only if every branch reads the same
    range exchange: exactly one is planned, the others are reuses of it."""
    hot = recency_flags(call_rows(spark, SF), skew=Skew(least_rows=1, factor=0))
    for name, df in {"hot phones": hot, **{n: ALL_QUERIES[n](spark, SF) for n in ("ranked_values", "assign_key")}}.items():
        final = _final(df)
        rng = [line for line in final.split("\n") if "rangepartitioning" in line]
        assert sum("ReusedExchange" not in line for line in rng) == 1, name
        assert sum("ReusedExchange" in line for line in rng) >= 1, name
