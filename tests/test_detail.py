from dialtone.operators.detail import build_detail
from dialtone.operators.joins import Skew
from dialtone.sources.ivr_schema import DETAIL_COLUMNS

from conftest import rows
from fixtures import calls_rows, ivr_frames, modules_rows, steps_rows


def brute_detail_keys():
    """(call id, module seq, step seq) per detail row, by nested loops."""
    out = []
    for c in calls_rows():
        cid = c[0]
        mods = [m for m in modules_rows() if m[0] == cid]   # 0.0 == -0.0 in Python too
        if not mods:
            out.append((cid, None, None))
            continue
        for m in mods:
            st = [s for s in steps_rows() if s[0] == m[0] and s[1] == m[1]]
            if not st:
                out.append((cid, m[1], None))
            for s in st:
                out.append((cid, m[1], s[2]))
    return sorted(out, key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


def _keys(df):
    got = [(r[0], r[1], r[2]) for r in
           df.select("calls_ivr_id", "module_sequece", "step_sequence").collect()]
    return sorted(got, key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


def test_detail_matches_nested_loops(spark):
    calls, mods, steps = ivr_frames(spark)
    det = build_detail(calls, mods, steps)
    assert det.columns == DETAIL_COLUMNS
    assert _keys(det) == brute_detail_keys()


def test_salted_equals_plain_left_joins(spark):
    calls, mods, steps = ivr_frames(spark)
    plain = rows(build_detail(calls, mods, steps, skew=None))
    # every key is hot: all are salted, also 0.0 against -0.0
    assert rows(build_detail(calls, mods, steps, skew=Skew(least_rows=1, factor=0, rows_per_salt=1))) == plain
    assert rows(build_detail(calls, mods, steps)) == plain


def test_every_call_kept_and_orphan_step_lost(spark):
    calls, mods, steps = ivr_frames(spark)
    det = build_detail(calls, mods, steps)
    ids = {r[0] for r in det.select("calls_ivr_id").distinct().collect()}
    assert ids == {c[0] for c in calls_rows()}                       # I8
    assert det.filter("customer_phone = '999'").count() == 0         # step 13.0 has no module
    no_module = det.filter("calls_ivr_id = 8.0").collect()
    assert len(no_module) == 1 and no_module[0].module_sequece is None
    no_step = det.filter("calls_ivr_id = 3.0").collect()
    assert len(no_step) == 1 and no_step[0].module_name == "OTHER" and no_step[0].step_name is None


def test_negative_zero_id_joins(spark):
    calls, mods, steps = ivr_frames(spark)
    det = build_detail(calls, mods, steps).filter("calls_ivr_id = 0.0")
    assert [r.customer_phone for r in det.collect()] == ["800"]


def test_date_ids(spark):
    calls, mods, steps = ivr_frames(spark)
    det = build_detail(calls, mods, steps).filter("calls_ivr_id = 3.0")
    r = det.first()
    assert r.calls_start_date_id == "20240102" and r.calls_end_date_id == "20240102"
