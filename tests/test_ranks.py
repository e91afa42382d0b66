"""Ranks of many columns in one call a group against Spark's own windows."""

import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators import cross


def test_ranked(spark):
    rng = random.Random(1)
    rows = [(i % 7, i, *(rng.choice([None, float("nan"), float("inf"), -0.0, 0.0, 1.5, rng.random()]) for _ in range(3)), rng.choice([None, 1, 2])) for i in range(400)]
    df = spark.createDataFrame([*rows, (99, 400, None, None, None, None)], "day int, id int, a double, b double, c double, d int").repartition(5)
    cols = ["a", "b", "c", "d"]
    want = {r.id: r for r in df.select("id", *[(F.rank().over(Window.partitionBy("day", F.col(c).isNull()).orderBy(c)) + (F.count("*").over(Window.partitionBy("day", c)) - 1) / 2).alias(c) for c in cols], *[F.col(c).isNull().alias(f"no_{c}") for c in cols], *[F.count(c).over(Window.partitionBy("day")).alias(f"n_{c}") for c in cols]).collect()}
    for r in cross.ranked(df, cols, ["day"]).collect():
        assert all(r[c] is None if want[r.id][f"no_{c}"] else r[c] == want[r.id][c] for c in cols)
    for r in cross.rank01(df, cols, ["day"]).collect():
        assert all(r[c] == (0.5 if want[r.id][f"no_{c}"] else (want[r.id][c] - 1) / max(want[r.id][f"n_{c}"] - 1, 1)) for c in cols)
    assert cross.rank01(df.limit(0), cols, ["day"]).count() == 0


def test_average_ranks_of_ties():
    x, one = np.array([3.0, 1.0, 3.0, np.nan, np.nan, 2.0]), np.zeros(6, int)
    assert list(cross.average_ranks(x, one)) == [3.5, 1, 3.5, 5.5, 5.5, 2]
    assert list(cross.average_ranks(x, np.array([0, 1, 0, 1, 1, 1]))) == [1.5, 1, 1.5, 3.5, 3.5, 2]
    assert len(cross.average_ranks(x[:0], one[:0])) == 0


def test_traits_take_one_sort_for_the_ranks(spark, sf_dir):
    from barloom.plans import registry

    plan = registry.QUERIES["w16_traits"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("FlatMapGroupsInArrow") + 400]
    assert plan.count("FlatMapGroupsInArrow") == 1 and after.count("Window") == 0


def test_rolling_sums(spark):
    rng = random.Random(8)
    rows = [(c, t, rng.choice([None, float("nan"), 1e6 * rng.random(), rng.random()]), rng.randint(0, 1)) for c, n in ((1, 400), (2, 119), (3, 1), (4, 120), (5, 121), (6, 240)) for t in range(n)]
    df = spark.createDataFrame(rows, "code_idx int, trade_date_idx int, a double, b int").repartition(3)
    for n in (120, 7):
        got = {(r.code_idx, r.trade_date_idx): r for r in cross.rolling_sums(df, {"sa": F.col("a"), "sb": F.col("b")}, n).collect()}
        assert len(got) == len(rows)
        for c in range(1, 7):
            own = [r for r in rows if r[0] == c]
            for i, r in enumerate(own):
                frame = own[max(i - n, 0) : i]
                there = [x[2] for x in frame if x[2] is not None and not np.isnan(x[2])]
                g = got[r[:2]]
                assert g.n_sa == len(there) and g.n_sb == len(frame) and g.sb == sum(x[3] for x in frame) and abs(g.sa - sum(there)) < 1e-6
