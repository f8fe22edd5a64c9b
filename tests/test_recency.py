import random
from datetime import datetime, timedelta

import pytest

from dialtone.operators.joins import Skew
from dialtone.operators.recency import hot_entities, recency_flags
from dialtone.plans import ivr_jobs

from conftest import rows

# no phone is hot; phones with 100 calls; every phone
FORMS = [None, Skew(least_rows=100, factor=0), Skew(least_rows=0, factor=0)]
SCHEMA = "calls_ivr_id double, calls_phone_number string, calls_start_date timestamp"


def brute(data, hours=24):
    """Expected semantics by hand: distinct rows, per phone ordered by
    (start NULLS FIRST, id), previous/next start, flags on whole hours."""
    distinct = sorted(set(data), key=lambda r: (r[1] is None, r[1] or "",
                                                 r[2] is not None, r[2] or datetime.min, r[0] is not None, r[0] or 0))
    out = []
    by_phone = {}
    for r in distinct:
        by_phone.setdefault(r[1], []).append(r)
    for phone, rs in by_phone.items():
        for i, (cid, ph, t) in enumerate(rs):
            prev = rs[i - 1][2] if i > 0 else None
            nxt = rs[i + 1][2] if i + 1 < len(rs) else None

            def whole(a, b):  # hours from b to a, truncated toward zero
                return int((a - b) / timedelta(hours=1))
            rep = int(prev is not None and t is not None and whole(t, prev) < hours)
            cau = int(nxt is not None and t is not None and whole(nxt, t) < hours)
            out.append((cid, ph, t, prev, nxt, rep, cau))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_boundaries(spark):
    t = datetime(2024, 1, 1, 8, 0, 0)
    data = [(1.0, "a", t), (2.0, "a", t + timedelta(hours=24)),               # exactly 24h: no
            (3.0, "b", t), (4.0, "b", t + timedelta(hours=23, minutes=59, seconds=59))]  # 23:59:59: yes
    df = spark.createDataFrame(data, SCHEMA)
    for skew in FORMS:
        got = {r[0]: (r[5], r[6]) for r in recency_flags(df, skew=skew).collect()}
        assert got == {1.0: (0, 0), 2.0: (0, 0), 3.0: (0, 1), 4.0: (1, 0)}


@pytest.mark.parametrize("skew", FORMS)
def test_ties_broken_by_call_id(spark, skew):
    t = datetime(2024, 1, 1, 8, 0, 0)
    data = [(9.0, "a", t), (2.0, "a", t), (5.0, "a", t + timedelta(hours=1))]
    got = {r[0]: (r[3], r[4])
           for r in recency_flags(spark.createDataFrame(data, SCHEMA), skew=skew).collect()}
    assert got[2.0] == (None, t) and got[9.0] == (t, t + timedelta(hours=1))


def test_burst_on_one_phone(spark):
    """A third of all rows on one phone at one instant: positions still split."""
    t = datetime(2024, 1, 1, 8, 0, 0)
    data = [(float(i), "HOT" if i % 3 == 0 else f"p{i % 7}",
             t if i % 3 == 0 else t + timedelta(minutes=i)) for i in range(900)]
    df = spark.createDataFrame(data, SCHEMA)
    assert hot_entities(df, "calls_phone_number", FORMS[1]) == ["HOT"]
    assert rows(recency_flags(df, skew=FORMS[1])) == rows(recency_flags(df, skew=None))


def _random_calls(seed, n=600):
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)
    out = []
    for i in range(n):
        r = rnd.random()
        phone = "HOT" if r < 0.34 else (None if r < 0.4 else ("UNKNOWN" if r < 0.45
                                                              else f"p{rnd.randint(0, 30)}"))
        start = None if rnd.random() < 0.03 else base + timedelta(
            seconds=rnd.choice([0, 3600, 86399, 86400]) * rnd.randint(0, 3)
            + rnd.randint(0, 20) * 1800)
        out.append((float(rnd.randint(0, n)), phone, start))   # ids repeat, times tie
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("skew", FORMS)
def test_forms_equal_brute_force(spark, seed, skew):
    data = _random_calls(seed)
    assert rows(recency_flags(spark.createDataFrame(data, SCHEMA), skew=skew)) == brute(data)


def test_null_phone_may_be_hot(spark):
    data = [(c, None if p == "HOT" else p, t) for c, p, t in _random_calls(5)]
    df = spark.createDataFrame(data, SCHEMA)
    assert hot_entities(df, "calls_phone_number", FORMS[1]) == [None]
    assert rows(recency_flags(df, skew=FORMS[1])) == brute(data)


def test_table_by_phone_needs_no_exchange(spark):
    df = spark.createDataFrame(_random_calls(6), SCHEMA)
    for skew in (None, FORMS[1]):
        laid = ivr_jobs.save_by_phone(df, "calls_by_phone", 4)
        out = recency_flags(laid, skew=skew)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan
        if skew is None:
            assert "Exchange" not in plan
        else:   # the hot phone's ranges only
            usual = plan.split("Union")[1].split("rangepartitioning")[0]
            assert "Window" in usual.split("Scan parquet spark_catalog")[0] and "hashpartitioning(calls_phone_number" not in plan
        assert rows(out) == rows(recency_flags(df, skew=skew))
    spark.sql("DROP TABLE calls_by_phone")


def test_repeated_equals_recalls(spark):
    df = spark.createDataFrame(_random_calls(7), SCHEMA)
    s = recency_flags(df).agg({"repeated_phone_24H": "sum", "cause_recall_phone_24H": "sum"}).first()
    assert s[0] == s[1]                                                     # I7
