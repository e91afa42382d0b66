"""Joins of days and intervals on equal keys, windows and segments that do no more work than they return."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import calendar as cal
from barloom.operators import bars, quality, samples
from barloom.plans import registry


@pytest.mark.parametrize("name", ["c07_bisect_idx", "j03_reference_price", "j05_prev_session", "j06_densify", "j07_gaps", "i08_fills_tail"])
def test_no_nested_loops(spark, sf_dir, name):
    assert "NestedLoop" not in registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_positions(spark):
    days = [datetime.date(2025, 1, n) for n in (2, 3, 6, 7, 10)]
    calendar = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "date date, tdi int")
    every = [datetime.date(2024, 12, 28) + datetime.timedelta(n) for n in range(20)]
    df = spark.createDataFrame([(d,) for d in every] + [(None,)], "date date")
    assert {r.date: r.pos for r in cal.bisect_idx(df, calendar).collect() if r.date} == {d: sum(x <= d for x in days) for d in every}
    spans = [(i, a, b) for i, (a, b) in enumerate((random.Random(i).choice(every), random.Random(-i - 1).choice(every)) for i in range(40))]
    got = cal.days_between(spark.createDataFrame(spans, "id int, lo date, hi date"), calendar, F.col("lo"), F.col("hi"))
    assert sorted((r.id, r.date) for r in got.collect()) == sorted((i, d) for i, a, b in spans for d in days if a <= d <= b)
    prev = cal.prev_session(df.where("date is not null"), calendar).collect()
    assert {(r.date, r.prev_date, r.prev_tdi) for r in prev} == {(d, max(x for x in days if x < d), sum(x < d for x in days) - 1) for d in every if d > days[0]}


def test_actions_meet_their_day_only(spark):
    rng = random.Random(4)
    d0 = datetime.date(2025, 1, 1)
    rows = [("a", d0 + datetime.timedelta(i), rng.choice([9.0, 10.0, 11.0]), 9.5, int(rng.random() > 0.3)) for i in range(0, 60, 2)]
    acts = [("a", d0 + datetime.timedelta(rng.randrange(-3, 66)), 0.1, 0.0, 0.0, 0.0) for _ in range(15)]
    df = spark.createDataFrame(rows, "code string, date date, close double, preclose double, tradestatus int")
    actions = spark.createDataFrame(acts, "code string, ex_date date, dividend_per_share double, per_share_bonus double, allotment_ratio double, allotment_price double")
    got = {r.date: r.preclose for r in bars.reference_price(df, actions).collect()}
    last, since = None, None
    for _, date, close, pre, on in rows:
        if not on:
            assert got[date] == close
            continue
        base, after = (pre, date - datetime.timedelta(1)) if last is None else (last, since)
        sums = {}
        for a in acts:
            if after < a[1] <= date:
                sums[a[1]] = sums.get(a[1], 0) + a[2]
        want = base
        if sums:
            f = base
            for x in sums.values():
                f *= (base - x) / base
            want = round(f + 1e-9, 2)
        assert abs(got[date] - want) < 0.0101
        last, since = close, date


def test_windows_asked_for(spark):
    rng = random.Random(2)
    d0 = datetime.date(2025, 1, 1)
    rows = [(c, d0 + datetime.timedelta(i), rng.choice([None, float("nan"), 1.5, rng.random()])) for c in "abc" for i in range(30) if rng.random() < 0.8]
    ids = [("a", r[1]) for r in rows if r[0] == "a"][::5] * 2 + [("b", rows[-1][1]), ("b", d0), ("z", d0), ("c", datetime.date(1999, 1, 1))]
    got = samples.materialise(spark.createDataFrame(ids, "code string, date date"), spark.createDataFrame(rows, "code string, date date, x double").repartition(4), 7, ["x", "none"])
    have = {}
    for c, d, x in rows:
        have.setdefault(c, []).append((d, 0.0 if x is None or np.isnan(x) else x))
    want = {}
    for c, d in ids:
        own = [x for x in have.get(c, []) if x[0] <= d]
        if own and own[-1][0] == d:
            want[c, d] = [x for _, x in own[-7:]]
    assert {(r.code, r.date): r.x for r in got.collect()} == want and got.count() == len(want)


def test_many_gaps_of_one_code(spark):
    rng = np.random.default_rng(1)
    gaps = np.unique(rng.integers(0, 2_000_000, 120_000))
    df = spark.createDataFrame([("a", int(x)) for x in gaps] + [("b", 7), ("b", 7), ("b", None)], "code string, tdi int")
    want, lo, hi = [], None, None
    for x in gaps.tolist():
        if lo is None or x - lo >= 60:
            want += [] if lo is None else [("a", lo, hi)]
            lo = x
        hi = x
    got = sorted(map(tuple, quality.gap_segments(df).select("code", "lo", "hi").collect()))
    assert got == [*want, ("a", lo, hi), ("b", 7, 7)]
