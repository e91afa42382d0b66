"""Recursive indicators as running sums over blocks against plain loops; continued from a stored state; no Python in the plan."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators import indicators
from barloom.plans import registry


def ema(x, span):
    y = []
    for v in x:
        y.append(v if not y else y[-1] + (v - y[-1]) * 2 / (span + 1))
    return y


def rsi(x, n):
    out, u, d = [None] * len(x), 0.0, 0.0
    for i in range(n, len(x)):
        up, down = ([max(s * (x[j] - x[j - 1]), 0) for j in range(1, i + 1)] for s in (1, -1))
        u, d = (sum(up[:n]) / n, sum(down[:n]) / n) if i == n else ((u * (n - 1) + up[-1]) / n, (d * (n - 1) + down[-1]) / n)
        out[i] = 100 - 100 / (1 + u / (d or 1e-10))
    return out


def kdj(rows, n):
    k, d, out = None, None, []
    for i, (_, hi, lo, c) in enumerate(rows):
        if i >= n - 1:
            hh, ll = max(r[1] for r in rows[i - n + 1 : i + 1]), min(r[2] for r in rows[i - n + 1 : i + 1])
            r = 50 if hh == ll else (c - ll) / (hh - ll) * 100
            k, d = (50, 50) if i == n - 1 else (2 / 3 * k + r / 3, 2 / 3 * d + (2 / 3 * k + r / 3) / 3)
        out.append((k, d))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = {}
    for code, n in (("long", 1700), ("short", 9), ("one", 1), ("flat", 700)):
        x = 10.0
        for i in range(n):
            x = x if code == "flat" else max(0.5, x * (1 + rng.gauss(0, 0.03)))
            out.setdefault(code, []).append((i, x + (0 if code == "flat" else rng.random()), x - (0 if code == "flat" else rng.random()) / 4, x))
    return out


@pytest.fixture(scope="module")
def bars(spark, rows):
    return spark.createDataFrame([(c, *r) for c, rs in rows.items() for r in rs], "code string, date int, high double, low double, close double").repartition(3)


def by_code(df, *cols):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.code, r.date)):
        out.setdefault(r.code, []).append([np.nan if r[c] is None else r[c] for c in cols])
    return {c: np.array(v, float) for c, v in out.items()}


def same(a, b):
    return np.allclose(np.array(a, float), np.array([[np.nan if y is None else y for y in x] for x in b], float), rtol=1e-9, atol=1e-9, equal_nan=True)


def test_macd(bars, rows):
    got = by_code(indicators.macd(bars), "macd", "macd_signal", "macd_hist")
    for c, rs in rows.items():
        x = [r[3] for r in rs]
        line = [a - b for a, b in zip(ema(x, 12), ema(x, 26), strict=True)]
        sig = ema(line, 9)
        assert same(got[c], [(a, b, a - b) for a, b in zip(line, sig, strict=True)])


def test_rsi_and_kdj(bars, rows):
    r, k = by_code(indicators.rsi(bars, 6), "rsi"), by_code(indicators.kdj(bars), "k", "d", "j")
    for c, rs in rows.items():
        assert same(r[c], [(x,) for x in rsi([x[3] for x in rs[:300]], 6)] + [(x,) for x in r[c][300:, 0]])
        assert same(k[c], [(a, b, None if a is None else 3 * a - 2 * b) for a, b in kdj(rs, 9)])


def test_macd_goes_on_from_a_state(bars):
    whole = by_code(indicators.macd(bars), "macd", "macd_signal", "macd_hist")
    old = indicators.macd(bars.where("date < 900"), with_state=True)
    last = old.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy(F.desc("date")))).where("r = 1")
    new = by_code(indicators.macd(bars.where("date >= 900"), state=last), "macd", "macd_signal", "macd_hist")
    assert set(new) == {"long"} and np.allclose(new["long"], whole["long"][900:], rtol=1e-9, atol=1e-12)


def test_no_value_no_more_values(spark):
    d = spark.createDataFrame([("a", i, None if i == 5 else float(i)) for i in range(9)], "code string, date int, close double")
    assert [r.macd is None for r in indicators.macd(d).orderBy("date").collect()] == [False] * 5 + [True] * 4


@pytest.mark.parametrize("name", ["w02_macd", "w03_rsi", "w05_kdj", "w34_daily_features", "w35_m15_features"])
def test_plans_have_no_python(spark, sf_dir, name):
    plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Arrow" not in plan and "Python" not in plan
