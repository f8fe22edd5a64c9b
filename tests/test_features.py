from dialtone.operators import features as feat
from dialtone.operators import profile
from dialtone.operators.detail import build_detail

from conftest import rows
from fixtures import ivr_frames


def _detail(spark):
    return build_detail(*ivr_frames(spark))


def test_classify_label_per_call(spark):
    got = {r[0]: r[2] for r in feat.classify_label(_detail(spark)).collect()}
    assert got[1.0] == "FRONT" and got[2.0] == "TECH" and got[3.0] == "ABSORPTION"
    assert got[5.0] == "RESTO" and got[6.0] == "RESTO" and got[9.0] == "TECH"


def test_collect_structs_in_rank_order(spark):
    got = {r[0]: (r[1], [tuple(x) for x in r[2]])
           for r in feat.collect_structs(_detail(spark)).collect()}
    assert got[1.0] == (2, [("DNI", "111A"), ("DNI", "222B")])
    assert got[2.0] == (1, [("NIE", "X9")])
    assert 5.0 not in got and 6.0 not in got        # NULL parts drop out like != 'UNKNOWN'


def test_collect_parallel_aligned(spark):
    got = {r[0]: r for r in feat.collect_parallel(_detail(spark)).collect()}
    r = got[1.0]
    assert r.documents_types == ["DNI", "DNI"] and r.document_identifications == ["111A", "222B"]
    for r in got.values():                            # I6
        assert len(r.documents_types) == len(r.document_identifications) == r.docs_per_call


def test_collect_values_min_count(spark):
    det = _detail(spark)
    all_ = {r[0]: (r[1], list(r[2])) for r in feat.collect_values(det).collect()}
    assert all_[1.0] == (2, ["B1", "B2"]) and all_[7.0] == (1, ["B7"])
    multi = {r[0] for r in feat.collect_values(det, min_count=2).collect()}
    assert multi == {1.0}


def test_presence_flags(spark):
    det = _detail(spark)
    flags = {r[0]: r[1:] for r in feat.presence_flags(det, {
        "m": feat.mass_outage_pred(), "p": feat.info_by_phone_pred(),
        "pr": feat.info_by_phone_pred(refined=True), "d": feat.info_by_dni_pred()}).collect()}
    assert flags[1.0] == (1, 1, 1, 1)
    assert flags[2.0] == (0, 1, 0, 0)                 # flagged without a phone
    assert flags[4.0] == (1, 0, 0, 0)
    assert flags[8.0] == (0, 0, 0, 0)                 # no module: NULL predicate -> 0
    for p, pr in [(v[1], v[2]) for v in flags.values()]:
        assert pr <= p                                # I5


def test_flag_by_sum_equals_max_form(spark):
    det = _detail(spark)
    a = feat.presence_flag(det, feat.info_by_dni_pred(), "f")
    b = feat.presence_flag_by_sum(det, feat.info_by_dni_pred(), "f")
    assert rows(a) == rows(b)                         # I2


def test_profile_counts(spark):
    det = _detail(spark)
    kc = profile.key_cardinality(det).first()
    assert kc.total_registros == det.count() and kc.total_registros_unicos == 13
    cov = profile.combination_coverage(det).first()
    assert (cov.num_unique_calls, cov.total_combinations) == (3, 5)
    hist = dict(profile.values_per_key_histogram(det).collect())
    # call 7's ('A-B','C') and ('A','B-C') join to the same text: counted once
    assert hist == {1: 2, 2: 1}


def test_ranked_values_forms_agree(spark):
    det = _detail(spark)
    a = profile.ranked_values(det, min_count=1)
    b = profile.ranked_values(det, min_count=1, skew_safe=False)
    assert rows(a) == rows(b)
    got = [(r.calls_ivr_id, r.document_identification, r.rn, r.docs_per_call)
           for r in profile.ranked_values(det).collect()]
    assert sorted(got, key=str) == sorted([(1.0, "111A", 1, 2), (1.0, "222B", 2, 2),
                                           (7.0, "B-C", 1, 2), (7.0, "C", 2, 2)], key=str)


def test_phone_groups(spark):
    det = _detail(spark)
    per = rows(profile.distinct_per_group(det))
    assert (4.0, "700", 1) in per and (4.0, "701", 1) in per
    assert {r[0]: r[1] for r in profile.multi_valued_keys(det, col="customer_phone").collect()} == {4.0: 2}


def test_ordered_reports(spark):
    det = _detail(spark)
    got = [(r.calls_ivr_id, r.rn) for r in profile.ranked_values(det, ordered=True).collect()]
    assert got == sorted(got)
    keys = [r.calls_ivr_id for r in profile.distinct_per_group(det, ordered=True).collect()]
    assert keys == sorted(keys)


def test_collected_values_are_distinct_before_the_buffer(spark):
    """A call with 10^6 repeats of 10 values: the rows collected are 10."""
    df = spark.range(1_000_000).selectExpr("if(id >= 0, 1.0D, 2.0D) AS calls_ivr_id", "cast(id % 10 AS string) AS billing_account_id")
    out = feat.collect_values(df)
    assert [tuple(r) for r in out.collect()] == [(1.0, 10, [str(i) for i in range(10)])]
    plan = out._jdf.queryExecution().executedPlan()
    # the collecting aggregate reads the exchange of the distinct rows
    text = plan.toString().split("\n+- == Initial Plan ==")[0]
    collecting = text[text.rindex("partial_collect_list"):]
    assert "hashpartitioning(calls_ivr_id" in collecting and "billing_account_id" in collecting.split("hashpartitioning(")[1].split(")")[0]


def test_histogram_of_tuples(spark):
    hist = dict(profile.values_per_key_histogram(_detail(spark), sep=None).collect())
    assert hist == {1: 1, 2: 2}                       # ('A-B','C') and ('A','B-C') are two
