import random
from datetime import datetime, timedelta

import pytest

from dialtone.operators.detail import build_detail, prefixed_calls
from dialtone.operators import facts, profile
from dialtone.operators.summary import base_by_max, best_row, build_summary, summary_from_tables
from dialtone.sources.ivr_schema import CALLS_SCHEMA, MODULES_SCHEMA, STEPS_SCHEMA, SUMMARY_COLUMNS

from conftest import rows
from fixtures import ivr_frames
from test_recency import brute as brute_repeats


def _norm(df):
    return rows(df.select([df[c].cast("string") if c in ("document_type", "document_identification",
                                                         "billing_account_id") else df[c]
                           for c in df.columns]))


def random_ivr(spark, seed, n_calls=120):
    """Calls with reused and NULL ids, NULL labels, several phones per call."""
    rnd = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    labels = ["ATC_x", "tech", "ABSORPTION", None, "zz"]
    calls = []
    for i in range(n_calls):
        cid = None if rnd.random() < 0.03 else float(rnd.randint(0, n_calls // 2))
        phone = rnd.choice([None, "UNKNOWN", "p1", "p2", "p3"])
        start = t0 + timedelta(hours=rnd.randint(0, 90))
        calls.append((cid, phone, "r", rnd.choice(labels), start, start, rnd.randint(1, 9),
                      rnd.choice(["A", "B"]), "ES", rnd.randint(0, 3), "M"))
    mods, steps = [], []
    for cid in {c[0] for c in calls if c[0] is not None}:
        for seq in range(rnd.randint(0, 3)):
            mods.append((cid, seq, rnd.choice(["AVERIA_MASIVA", "OTHER"]), 5, "OK"))
            for k in range(rnd.randint(0, 3)):
                steps.append((cid, seq, k, rnd.choice(["CUSTOMERINFOBYPHONE.TX", "CUSTOMERINFOBYDNI.TX", "X"]),
                              rnd.choice(["OK", "KO", None]), None,
                              rnd.choice(["DNI", "UNKNOWN", None]), rnd.choice(["1", "2", "UNKNOWN"]),
                              rnd.choice(["600", "601", "UNKNOWN", None]),
                              rnd.choice(["b1", "b2", "UNKNOWN", None])))
    return (spark.createDataFrame(calls, CALLS_SCHEMA), spark.createDataFrame(mods, MODULES_SCHEMA),
            spark.createDataFrame(steps, STEPS_SCHEMA))


def collected(df):
    """Rows with arrays as tuples, in an order of their own."""
    return sorted((tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect()), key=str)


def brute_detail(calls, mods, steps):
    """Nested loops: (call row, module row or None, step row or None)."""
    out = []
    for c in calls:
        mine = [m for m in mods if c[0] is not None and m[0] == c[0]] or [None]
        for m in mine:
            of = [s for s in steps if m is not None and m[1] is not None and s[0] == m[0] and s[1] == m[1]] or [None]
            out += [(c, m, s) for s in of]
    return out


def known(v):
    return v is not None and v != "UNKNOWN"


def brute_flags(detail):
    ok = lambda s, name: s is not None and s[3] == name and s[4] == "OK"
    return (int(any(m is not None and m[2] == "AVERIA_MASIVA" for _, m, _ in detail)),
            int(any(ok(s, "CUSTOMERINFOBYPHONE.TX") for *_, s in detail)),
            int(any(ok(s, "CUSTOMERINFOBYPHONE.TX") and known(s[8]) for *_, s in detail)),
            int(any(ok(s, "CUSTOMERINFOBYDNI.TX") for *_, s in detail)))


def down(values):
    """Descending, NULLs last."""
    return tuple((v is not None, v if v is not None else 0) for v in values)


def brute_summary(calls, mods, steps, method):
    """The 20 columns of every call, from what the summary means."""
    base = [1, 2, 4, 5, 6, 7, 8, 9, 10]
    repeats = {(r[0], r[1], r[2]): r[5:] for r in brute_repeats([(c[0], c[1], c[4]) for c in calls])}
    out = []
    for cid in {c[0] for c in calls}:
        detail = brute_detail([c for c in calls if c[0] == cid], mods, steps)
        rows_ = [c for c, _, _ in detail]
        if method == "max":
            own = [max((c[i] for c in rows_ if c[i] is not None), default=None) for i in base]
        else:
            score = lambda x: (known(x[0][1]) + known(x[2] and x[2][8]) + known(x[2] and x[2][9]))
            best = max(detail, key=lambda x: (score(x), *down([*(x[0][i] for i in base), x[2] and x[2][8], x[2] and x[2][9]])))
            own = [best[0][i] for i in base]
        if cid is None:
            out.append((None, *own[:2], None, *own[2:], *[None] * 9))
            continue
        found = [s for *_, s in detail if s is not None]
        docs = sorted({(s[6], s[7]) for s in found if known(s[6]) and known(s[7])})
        phones = {s[8] for s in found if known(s[8])} or {None}
        bills = tuple(sorted({s[9] for s in found if known(s[9])})) or None
        outage, _, by_phone, by_dni = brute_flags(detail)
        for label in {c[3] for c in rows_}:
            up = (label or "").upper()
            kind = ("FRONT" if up.startswith("ATC") else "TECH" if up.startswith("TECH")
                    else "ABSORPTION" if up == "ABSORPTION" else "RESTO")
            for phone in phones:
                for variant in {(c[1], c[4]) for c in rows_}:
                    out.append((cid, *own[:2], kind, *own[2:], tuple(d for d, _ in docs) or None, tuple(d for _, d in docs) or None,
                                phone, bills, outage, by_phone, by_dni, *repeats[(cid, *variant)]))
    return sorted(out, key=str)


def odd_ivr(spark, seed):
    """``random_ivr`` with repeated modules, modules without a sequence or a call, steps without a module."""
    calls, mods, steps = random_ivr(spark, seed, 80)
    extra_m = [(3.0, 1, "AVERIA_MASIVA", 5, "OK")] * 2 + [(4.0, None, "AVERIA_MASIVA", 5, "OK"), (999.0, 1, "OTHER", 5, "OK"), (None, 1, "AVERIA_MASIVA", 5, "OK")]
    step = (1, "CUSTOMERINFOBYDNI.TX", "OK", None, "DNI", "9", "609", "b9")
    extra_s = [(3.0, 1, *step)] * 2 + [(4.0, None, *step), (999.0, 1, *step), (5.0, 77, *step), (None, 1, *step)]
    return (calls, mods.unionByName(spark.createDataFrame(extra_m, MODULES_SCHEMA)),
            steps.unionByName(spark.createDataFrame(extra_s, STEPS_SCHEMA)))


@pytest.mark.parametrize("frames", [lambda s: ivr_frames(s), lambda s: random_ivr(s, 11), lambda s: odd_ivr(s, 12)])
@pytest.mark.parametrize("method", ["max", "best_row"])
def test_summaries_equal_brute_force(spark, frames, method):
    calls, mods, steps = frames(spark)
    want = brute_summary(*([tuple(r) for r in t.collect()] for t in (calls, mods, steps)), method)
    tables = summary_from_tables(prefixed_calls(calls), mods, steps, method)
    assert tables.columns == SUMMARY_COLUMNS
    assert collected(tables) == want
    det = build_detail(calls, mods, steps)
    assert collected(build_summary(det, method)) == want
    assert collected(build_summary(det, method, calls=prefixed_calls(calls))) == want


@pytest.mark.parametrize("frames", [lambda s: ivr_frames(s), lambda s: odd_ivr(s, 13)])
def test_facts_equal_the_detail(spark, frames):
    calls, mods, steps = frames(spark)
    t = (prefixed_calls(calls), mods, steps)
    det = build_detail(calls, mods, steps)
    assert facts.key_cardinality(*t).collect() == profile.key_cardinality(det).collect()
    assert rows(facts.best_row(*t)) == rows(best_row(det))
    names = {"masiva_lg": "m", "by_phone": "p", "by_known_phone": "k", "by_dni": "d"}
    plain = [tuple(r) for r in calls.collect()], [tuple(r) for r in mods.collect()], [tuple(r) for r in steps.collect()]
    want = sorted(((cid, *brute_flags(brute_detail([c for c in plain[0] if c[0] == cid], *plain[1:])))
                   for cid in {c[0] for c in plain[0]}), key=str)
    for by_sum in (False, True):
        assert sorted(map(tuple, facts.call_flags(*t, names, by_sum=by_sum).collect()), key=str) == want


def test_best_row_of_hot_repeated_and_null_calls(spark):
    """Calls without modules, modules without calls, repeated and NULL ids, a hot call, NULL columns."""
    call = lambda i, phone, result: (i, phone, result, None, None, None, 5, None, None, None, None)
    calls = [call(1.0, "UNKNOWN", "z"), call(1.0, "6", "a"), call(1.0, "6", None), call(None, None, "n"), call(None, "7", None),
             call(2.0, None, None), *[call(4.0, str(n), "r") for n in range(50)]]
    mods = [(1.0, 1, "M", None, None), (1.0, 1, "M", None, None), (3.0, 1, "M", None, None), (None, 1, "M", None, None),
            *[(4.0, n, "M", None, None) for n in range(40)]]
    step = lambda i, s, phone, bill: (i, s, 1, "S", "OK", None, None, None, phone, bill)
    steps = [step(1.0, 1, "UNKNOWN", "9"), step(1.0, 1, "5", None), step(1.0, 2, "5", "9"), step(3.0, 1, "5", "9"), step(None, 1, "5", "9"),
             *[step(4.0, n % 40, str(n), "UNKNOWN") for n in range(200)]]
    frames = [spark.createDataFrame(r, s) for r, s in ((calls, CALLS_SCHEMA), (mods, MODULES_SCHEMA), (steps, STEPS_SCHEMA))]
    found = facts.best_row(prefixed_calls(frames[0]), *frames[1:])
    assert rows(found) == rows(best_row(build_detail(*frames)))
    assert {r["calls_ivr_id"]: (r["calls_phone_number"], r["calls_ivr_result"], r["customer_phone"], r["billing_account_id"]) for r in found.collect()} == {
        None: ("7", None, None, None), 1.0: ("6", "a", "UNKNOWN", "9"), 2.0: (None, None, None, None), 4.0: ("9", "r", "99", "UNKNOWN")}


def test_facts_of_empty_tables(spark):
    empty = [spark.createDataFrame([], s) for s in (CALLS_SCHEMA, MODULES_SCHEMA, STEPS_SCHEMA)]
    t = (prefixed_calls(empty[0]), *empty[1:])
    assert summary_from_tables(*t).count() == 0 and facts.best_row(*t).count() == 0
    assert tuple(facts.key_cardinality(*t).first()) == (0, 0)


def test_fan_out_and_null_arrays(spark):
    det = build_detail(*ivr_frames(spark))
    s = build_summary(det).filter("ivr_id = 4.0").collect()
    assert sorted(r.customer_phone for r in s) == ["700", "701"]            # two phones, two rows
    one = build_summary(det).filter("ivr_id = 8.0").collect()
    assert len(one) == 1 and one[0].document_type is None and one[0].billing_account_id is None
    r1 = build_summary(det).filter("ivr_id = 1.0").first()
    assert r1.document_identification == ["111A", "222B"] and r1.billing_account_id == ["B1", "B2"]
    assert (r1.masiva_lg, r1.info_by_phone_lg, r1.info_by_dni_lg) == (1, 1, 1)


def test_methods_agree_when_ids_unique(spark):
    det = build_detail(*ivr_frames(spark))
    assert _norm(build_summary(det, "max")) == _norm(build_summary(det, "best_row"))   # I3


def test_null_id_row_has_null_features(spark):
    calls, mods, steps = random_ivr(spark, 5)
    det = build_detail(calls, mods, steps)
    nulls = build_summary(det).filter("ivr_id IS NULL").collect()
    if nulls:
        assert len(nulls) == 1
        r = nulls[0]
        assert r.vdn_aggregation is None and r.masiva_lg is None and r.repeated_phone_24H is None


def test_best_row_prefers_complete_rows(spark):
    df = spark.createDataFrame(
        [(1.0, "UNKNOWN", "x", None, None, None, None, None, None, None, "UNKNOWN", "UNKNOWN"),
         (1.0, "600", "y", None, None, None, None, None, None, None, "p", "UNKNOWN"),
         (1.0, "600", "z", None, None, None, None, None, None, None, "UNKNOWN", "b")],
        "calls_ivr_id double, calls_phone_number string, calls_ivr_result string, "
        "calls_start_date timestamp, calls_end_date timestamp, calls_total_duration long, "
        "calls_customer_segment string, calls_ivr_language string, calls_steps_module int, "
        "calls_module_aggregation string, customer_phone string, billing_account_id string")
    r = best_row(df).first()
    # two rows score 2; the tie goes to the larger payload (descending, NULLs last)
    assert r.calls_ivr_result == "z"
    assert base_by_max(df).first().calls_ivr_result == "z"
