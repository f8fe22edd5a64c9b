"""Counts at sf0.01, taken in DuckDB from the bindings of FIXTURES.md with every line item
as a step and a header module per customer; a regression check of bindings and semantics."""
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def q(spark, name):
    return entry.queries()[name](spark, SF)


def test_detail_shape(spark):
    det = q(spark, "ivr_detail")
    assert det.count() == 55118
    assert det.select("calls_ivr_id").distinct().count() == 10000
    assert det.filter("module_sequece IS NOT NULL").count() == 54990
    assert det.filter("step_sequence IS NOT NULL").count() == 53490


def test_profile_counts(spark):
    assert sorted(tuple(r) for r in q(spark, "values_per_key_histogram").collect()) == [(1, 3035), (2, 2688), (3, 1560), (4, 697), (5, 225), (6, 83), (7, 11), (8, 3)]
    assert q(spark, "ranked_values").select("calls_ivr_id").distinct().count() == 5267
    assert q(spark, "combination_coverage").first().num_unique_calls == 8302
    assert q(spark, "multi_valued_keys").count() == 2642


def test_feature_counts(spark):
    labels = dict(tuple(r) for r in q(spark, "classify_label").groupBy("vdn_aggregation").count().collect())
    assert labels == {"FRONT": 2006, "TECH": 2014, "ABSORPTION": 1982, "RESTO": 3998}
    assert q(spark, "flag_module").filter("masiva_lg = 1").count() == 7382
    assert q(spark, "flag_step").filter("info_by_phone_lg = 1").count() == 4447
    assert q(spark, "flag_step_refined").filter("info_by_phone_lg = 1").count() == 563
    rec = q(spark, "recency_flags").groupBy("repeated_phone_24H", "cause_recall_phone_24H").count()
    assert sorted(tuple(r) for r in rec.collect()) == [(0, 0, 155), (0, 1, 1010), (1, 0, 1010), (1, 1, 7825)]


def test_validation_counts(spark):
    assert q(spark, "check_foreign_key").count() == 257
    assert q(spark, "check_foreign_key_lineitem").count() == 0
    assert q(spark, "check_domain").count() == 4031


def test_invariant_histogram_sums(spark):
    """The histogram sums to the identified calls, and n * calls sums to the
    combinations (no '-' collisions in the driver's document values)."""
    hist = [tuple(r) for r in q(spark, "values_per_key_histogram").collect()]
    cov = q(spark, "combination_coverage").first()
    assert sum(c for _, c in hist) == cov.num_unique_calls
    assert sum(n * c for n, c in hist) == cov.total_combinations


def test_invariant_one_phone_per_group(spark):
    """I4: the distinct count per (call, phone) is always 1."""
    vals = {r[0] for r in q(spark, "distinct_per_group").select("phones_per_register").distinct().collect()}
    assert vals == {1}
