"""Cases that decide a rule: suspensions, tails that can be appended to, first traded rows, gates, snapshots, splits, carried events."""

import datetime
import itertools
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from barloom.operators import bars, indicators, quality, samples, themes
from barloom.plans.harness import Inputs
from barloom.plans.q_indicators import times6
from barloom.plans.registry import ORACLE_SQL, QUERIES


def day(n):
    return datetime.date(2025, 1, 1) + datetime.timedelta(n - 1)


@pytest.fixture(scope="module")
def calendar(spark):
    days = [day(n) for n in range(1, 40) if day(n).weekday() < 5]
    return spark.createDataFrame([(d, i) for i, d in enumerate(days)], "date date, tdi int")


def test_the_latest_announced_day_decides(spark, calendar):
    """The anchor is Monday the 6th."""
    announced = {"a": [3, 6, 10], "b": [9, 13, 14], "c": [2, 3, 6], "d": [2, 3], "e": [6, 7, 8], "f": [3, 6, 7, 9]}
    rows = spark.createDataFrame([(c, day(n)) for c, ns in announced.items() for n in ns], "code string, date date")
    got = {r.code: (r.start, r.end) for r in bars.suspended_runs(rows, calendar, "2025-01-06").collect()}
    assert got == {"a": (day(10), day(10)), "b": (day(13), day(14)), "c": (day(2), day(6)), "e": (day(6), day(8)), "f": (day(9), day(9))}


def test_the_query_walks_back_from_the_latest_of_all_days(spark, sf_dir):
    """Every code of all bars, against a walk day by day."""
    v = Inputs(spark, sf_dir)
    tdi = {r.date: r.tdi for r in v.calendar.collect()}
    days = {}
    for r in v.bars.where("(code_idx + trade_date_idx) % 5 > 0").select("code", "date").collect():
        days.setdefault(r.code, {})[tdi[r.date]] = r.date
    want = set()
    for code, held in days.items():
        at = last = max(held)
        while at - 1 in held:
            at -= 1
        if held[last] >= datetime.date(1995, 6, 15):
            want.add((code, held[at], held[last]))
    got = [(r.code, r.start, r.end) for r in QUERIES["w30_suspended_runs"](spark, sf_dir).collect()]
    assert len(got) == len(want) == len(days) and set(got) == want


def test_suspension_batch(spark):
    status = {"idle": "000", "stops": "1100", "back": "0001", "odd": "10x", "once": "0"}
    rows = [(f" {c} ", str(day(i + 1)), s if s != "x" else None) for c, ss in status.items() for i, s in enumerate(ss)]
    df = spark.createDataFrame([*rows, (None, "2025-01-01", "0"), ("nodate", "soon", "0"), ("", "2025-01-01", "0")], "code string, date string, tradestatus string")
    got = {r.code: (r.start, r.resumed, r.traded_before) for r in bars.suspension_batch(df).collect()}
    assert got == {"idle": (day(1), False, False), "stops": (day(3), False, True), "back": (None, True, False), "odd": (None, True, False), "once": (day(1), False, False)}


def test_a_long_question_without_an_answer(spark):
    asked = spark.createDataFrame([("a", 31, None), ("b", 30, None), ("c", 90, day(5)), ("d", 90, None), ("", 90, None)], "code string, days int, date date")
    rows = spark.createDataFrame([("d", str(day(1)), "1")], "code string, date string, tradestatus string")
    silent = bars.silent_codes(asked, rows, "2025-02-01")
    assert {(r.code, r.start) for r in silent.collect()} == {("a", datetime.date(2025, 2, 1)), ("c", day(5))}
    ledger = spark.createDataFrame([("a", day(2)), ("c", day(9)), ("d", day(1))], "code string, start date")
    merged = bars.merge_suspensions(ledger, bars.suspension_batch(rows).unionByName(silent))
    assert {(r.code, r.start) for r in merged.collect()} == {("a", day(2)), ("c", day(5))}


GOOD = {"volume": 5.0, "amount": 50.0, "turn": 1.0, "close": 10.0, "preclose": 9.0, "pctChg": 1.0, "tradestatus": 1, "isST": 0}
IDLE = {"volume": 0.0, "amount": 0.0, "turn": None, "close": 10.0, "preclose": 10.0, "pctChg": None, "tradestatus": 0, "isST": 0}
NEW = {"preclose": None, "pctChg": None}
SERIES = {
    "sound": (True, [GOOD | NEW, GOOD, IDLE]), "starts_idle": (True, [IDLE, GOOD | NEW, GOOD]), "old": (True, [GOOD, GOOD]), "only_idle": (True, [IDLE, IDLE]), "nan_idle": (True, [GOOD, IDLE | {"turn": float("nan")}]),
    "blank_later": (False, [GOOD | NEW, GOOD | {"preclose": None}]), "blank_second": (False, [GOOD, GOOD | NEW]), "amount": (False, [GOOD, GOOD | {"amount": None}]), "st": (False, [GOOD, GOOD | {"isST": None}]),
    "price": (False, [GOOD, GOOD | {"close": -1.0}]), "infinite": (False, [GOOD, GOOD | {"close": float("inf")}]), "turn": (False, [GOOD, GOOD | {"turn": None}]), "status": (False, [GOOD, GOOD | {"tradestatus": 0}]),
    "no_status": (False, [GOOD, GOOD | {"tradestatus": None}]), "idle_pct": (False, [GOOD, IDLE | {"pctChg": 0.0}]), "idle_turn": (False, [GOOD, IDLE | {"turn": 0.0}]), "idle_amount": (False, [GOOD, IDLE | {"amount": None}]), "no_volume": (False, [GOOD, IDLE | {"volume": None}]),
}


def series(spark, extra=()):
    rows = [(c, day(i + 1), *(r[k] for k in GOOD)) for c, (_, rs) in SERIES.items() for i, r in enumerate(rs)]
    return spark.createDataFrame([*rows, *extra], "code string, date date, volume double, amount double, turn double, close double, preclose double, pctChg double, tradestatus int, isST int")


def test_tails_that_can_be_appended_to(spark):
    twice = [("twice", day(1), *GOOD.values())] * 2
    got = {r.code: r.append for r in quality.append_or_rewrite(series(spark, twice)).collect()}
    assert got == {c: ok for c, (ok, _) in SERIES.items()} | {"twice": False}


def test_the_first_traded_row_is_exempt(spark, calendar):
    d = series(spark).where("code in ('sound', 'starts_idle', 'blank_second')")
    span = d.groupBy("code").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    got = {r.code: (r.no_preclose, r.no_pct, r.complete) for r in quality.completeness(d, calendar, span).collect()}
    assert got == {"sound": (0, 0, True), "starts_idle": (0, 0, True), "blank_second": (1, 1, False)}


def test_bad_rows(spark):
    rows = [(1, 0, 0, 5.0, 1.0, 2.0, 1), (2, 1, 0, 5.0, 1.0, 2.0, 1), (3, 0, 1, 5.0, 1.0, 2.0, 1), (4, 0, 0, 5.0, None, 2.0, 0), (5, 0, 0, 0.0, None, None, 1), (6, 0, 0, None, None, None, 0), (7, 0, 0, 5.0, 1.0, float("nan"), 1)]
    d = spark.createDataFrame(rows, "id int, isST int, is_new int, volume double, x double, y double, m15_complete int")
    assert {r.id for r in d.where(samples.bad_rows(d, ("x", "y"))).collect()} == {2, 3, 4, 6}
    d = d.drop("m15_complete")
    assert {r.id for r in d.where(samples.bad_rows(d, ("x", "y"))).collect()} == {2, 3, 4, 7}
    d = d.drop("volume")
    assert {r.id for r in d.where(samples.bad_rows(d, ("x", "y"))).collect()} == {2, 3, 4, 5, 6, 7}


def test_lookup_in_a_stated_order(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "code string")
    rows = [("a", 48.0, 2.0), ("a", 21.0, 3.0), ("a", 25.0, 1.0), ("b", 7.0, 9.0)]
    for side in (spark.createDataFrame(rows, "code string, x double, theme double"), spark.createDataFrame(rows[::-1], "code string, x double, theme double").repartition(3)):
        got = {r.code: (r.x, r.theme) for r in samples.lookup_with_default(df, side, ["code"], 0.5, ["theme"]).collect()}
        assert got == {"a": (25.0, 1.0), "b": (7.0, 9.0), "c": (0.5, 0.5)}
        assert {r.code: r.x for r in samples.lookup_with_default(df, side, ["code"], 0.0, [F.col("theme").desc()]).collect()} == {"a": 21.0, "b": 7.0, "c": 0.0}
        assert {r.x for r in samples.lookup_with_default(df, side, ["code"], 0.0).collect()} == {21.0, 7.0, 0.0}


def test_name_changes_of_the_two_latest_snapshots(spark):
    rows = [("gone", "A", 1), ("gone", "B", 2), ("kept", "C", 1), ("kept", "D", 2), ("kept", "D", 3), ("new", "E", 3), ("now", "F", 2), ("now", "*F", 3), ("back", "G", 1), ("back", "H", 3)]
    got = bars.name_changes(spark.createDataFrame(rows, "code string, name string, snap int"))
    assert [tuple(r) for r in got.select("code", "old_name", "name").collect()] == [("now", "F", "*F")]


def test_splits(spark, calendar):
    ids = calendar.select(F.lit("a").alias("code"), "date")
    friday, monday = day(10), day(13)
    got = samples.split_samples(ids, "2025-01-02", "2025-01-06", str(friday), calendar).collect()
    assert {r.date for r in got if r.split == "validation"} == {day(n) for n in (6, 7, 8, 9, 10)} | {monday}
    got = samples.split_samples(ids, "2025-01-02", "2025-01-06", str(friday), exclusive=True).collect()
    assert {r.date for r in got if r.split == "validation"} == {day(n) for n in (7, 8, 9, 10)} and {r.date for r in got if r.split == "train"} == {day(n) for n in (2, 3, 6)}
    late = samples.split_samples(ids, "2025-01-02", "2025-01-06", "2025-03-01", calendar).agg(F.max("date").alias("d")).first().d
    assert late == calendar.agg(F.max("date")).first()[0]


def test_ratios_of_a_side(spark, calendar):
    df = calendar.select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("code"), "date", F.col("tdi").alias("trade_date_idx"))
    whole = samples.train_and_validation(df, 3, 2, "2025-01-01", "2025-01-20", "2025-01-31", calendar, train_horizon=1)
    part = samples.train_and_validation(df, 3, 2, "2025-01-01", "2025-01-20", "2025-01-31", calendar, train_horizon=1, ratios=(0.5, 1.0), seed=4)
    a, b = ({(r.split, r.code, r.date) for r in x.collect()} for x in (whole, part))
    assert b < a and {x for x in a if x[0] == "validation"} == {x for x in b if x[0] == "validation"}
    assert min(x[2] for x in a if x[0] == "train") == day(6)  # the fourth trading day
    n = {x[1]: sum(y[:2] == ("train", x[1]) for y in a) for x in a}
    assert {c: sum(y[:2] == ("train", c) for y in b) for c in n} == {c: k // 2 for c, k in n.items()}


def test_carried_events(spark):
    events = spark.createDataFrame([(0, "x", "a", 3.0), (2, "y", "a", 5.0), (4, "z", "b", 1.0)], "di int, entity string, code string, st_boards double")
    theme = spark.createDataFrame([(0, "x", 7), (1, "x", 8), (2, "y", 9)], "di int, entity string, size int")
    got = {(r.di, r.code): (r.entity, r.ks_days, r.st_boards, r.size) for r in themes.carry_events(events, theme).collect()}
    assert got == {(0, "a"): ("x", 0, 3.0, 7), (1, "a"): ("x", 0.25, 0.0, 8), (2, "a"): ("y", 0, 5.0, 9), (3, "a"): ("y", 0.25, 0.0, 0), (4, "a"): ("y", 0.5, 0.0, 0), (4, "b"): ("z", 0, 1.0, 0)}
    got = {(r.di, r.code): r["size"] for r in themes.carry_events(events, theme, carry="event").collect()}
    assert got == {(0, "a"): 7, (1, "a"): 7, (2, "a"): 9, (3, "a"): 9, (4, "a"): 9, (4, "b"): 0}


def test_stock_gap(spark):
    d = spark.createDataFrame([("e", "a", 1), ("e", "a", 4), ("e", "a", 200), ("f", "a", 5)], "entity string, code string, di int")
    assert sorted((r.entity, r.di, r.st_lastgap) for r in themes.stock_gap(d).collect()) == [("e", 1, 1.0), ("e", 4, 0.05), ("e", 200, 1.0), ("f", 5, 1.0)]


def test_carried_events_as_laid_out_and_ranked(spark):
    rng = random.Random(3)
    events = {(rng.randrange(30), f"e{rng.randrange(4)}", f"c{rng.randrange(6)}"): float(rng.randrange(1, 9)) for _ in range(60)}
    theme = {(d, f"e{n}"): d * 10 + n for d in range(30) for n in range(4) if (d + n) % 5}
    last, best = max(d for d, _, _ in events), {}
    for (d, e, c), boards in events.items():
        for k in range(5):
            if d + k <= last:
                best[d + k, c] = min(best.get((d + k, c), (9,)), (k, e, boards))
    df = spark.createDataFrame([(*k, x) for k, x in events.items()], "di int, entity string, code string, st_boards double").repartition(3)
    at = spark.createDataFrame([(*k, x) for k, x in theme.items()], "di int, entity string, size int")
    for carry in ("day", "event"):
        got = themes.carry_events(df, at, carry=carry)
        # events are shuffled as they are, before they are laid out over the days after
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate explode") < plan.index("Window")
        want = {(d, c): (e, k / 4, 0.0 if k else b, theme.get((d - k if carry == "event" else d, e), 0)) for (d, c), (k, e, b) in best.items()}
        rows = got.collect()
        assert {(r.di, r.code): (r.entity, r.ks_days, r.st_boards, r["size"]) for r in rows} == want and len(rows) == len(want)


def test_late_columns_of_days_with_several_rows(spark):
    rows = [(c, day(1), 1, 1.0) for c in "abcde"] + [("a", day(2), 1, None), ("a", day(2), 1, None), ("b", day(2), 1, None), ("b", day(2), 1, 2.0), ("b", day(2), 0, None), ("c", day(2), 0, None), ("d", day(2), 1, 3.0)]
    rows += [("e", day(2), 1, None), ("e", day(3), 1, 1.0), ("f", day(1), 1, None), ("f", day(2), 1, None)]
    for r in (rows, rows[::-1]):
        got = quality.late_columns(spark.createDataFrame(r, "code string, date date, tradestatus int, turn double").repartition(1), str(day(2)))
        assert sorted(x.code for x in got.collect()) == ["a", "a", "b"]


def test_idle_rows_that_lack_the_amount(spark):
    got = {r.code: r.append for r in quality.append_or_rewrite(series(spark), idle_amount_known=False).collect()}
    assert got == {c: ok for c, (ok, _) in SERIES.items()} | {"idle_amount": True}
    got = {r.code: r.append for r in quality.append_or_rewrite(series(spark)).collect()}
    assert got == {c: ok for c, (ok, _) in SERIES.items()}


def test_a_code_whose_wiped_amount_is_on_an_idle_row(spark, tmp_path):
    """Code 12 wipes its ninth row's amount; 12 * 31 + its day's place is a multiple of 41, so that row is idle."""
    first = datetime.datetime(1995, 1, 1)
    at = [d for d in range(60) if (12 * 31 + d) % 41][:8]
    idle = next(d for d in range(at[-1] + 1, 200) if (12 * 31 + d) % 41 == 0)
    rows = [(n, 0, 1, 1, 10.0, 100.0 + n, first + datetime.timedelta(n)) for n in range(200)] + [(1000 + n, 0, 12, 1, 10.0, 200.0 + n, first + datetime.timedelta(n)) for n in [*at, idle, idle + 1]]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.code: r.append for r in QUERIES["i08_append_or_rewrite"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    want = dict(c.execute(f"select code, append from ({ORACLE_SQL['i08_append_or_rewrite']})").fetchall())
    assert got == want and want["sz.300012"] is True


def test_tails_of_codes_that_suppliers_share(spark, tmp_path):
    """sz.004816 is the code of suppliers 4816 and 48166 (cut to four digits): their rows are as many as the days, with one day twice and one without."""
    first = datetime.datetime(1997, 12, 31)
    days = [first + datetime.timedelta(n) for n in range(9)]  # due: 1998-01-02 to 01-08
    rows = [(d, 1) for d in days]  # supplier 1 makes the calendar
    rows += [(d, 4816) for d in days[:6]] + [(d, 48166) for d in days[5:8]]  # 2 to 5 and 5 to 7 of January
    rows += [(d, 20) for d in days] + [(d, 22) for d in days[:8]] + [(d, 24) for d in days[:3] + days[4:]]
    table = [(n, 0, k, 1, 10.0, 100.0 + n, d) for n, (d, k) in enumerate(rows)]
    spark.createDataFrame(table, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.code: r.fills for r in QUERIES["i08_fills_tail"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    want = dict(c.execute(f"select code, fills from ({ORACLE_SQL['i08_fills_tail']})").fetchall())
    assert got == want and want["sz.004816"] is True and want["sh.600020"] is True and want["sz.300022"] is False

    frame = "code string, date date, volume double, close double"
    stored = spark.createDataFrame([(k, day(3), 1.0, 1.0) for k in "abcd"], frame)
    due = spark.createDataFrame([(day(n), n) for n in (2, 3, 6, 7)], "date date, tdi int")
    new = spark.createDataFrame([("a", day(6), 1.0, 1.0), ("a", day(7), 1.0, 1.0), ("b", day(6), 1.0, 1.0), ("b", day(6), 1.0, 1.0), ("c", day(6), 1.0, 1.0), ("d", day(6), 1.0, 1.0), ("d", day(8), 1.0, 1.0)], frame)
    assert {r.code: r.fills for r in quality.fills_tail(stored, new, due, str(day(7))).collect()} == {"a": True, "b": False, "c": False, "d": False}
    assert {r.code: r.fills for r in quality.fills_tail(stored, new, due, str(day(7)), days_once=False).collect()} == {"a": True, "b": True, "c": False, "d": False}


def test_side_rows_of_suppliers_that_share_a_code(spark, tmp_path):
    """bj.831000 is the code of suppliers 10004 and 10009; on the last day both have a row, in either order, and only the even one has a side row."""
    days = [datetime.datetime(1996, 1, 1) + datetime.timedelta(n) for n in range(36)]
    rows = [(n, 0, 10004, 1, 10.0, 100.0 + n, d) for n, d in enumerate(days)] + [(99, 0, 10009, 1, 10.0, 300.0, days[-1])]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(r.mix for r in QUERIES["d04_materialise"](spark, str(tmp_path)).where(F.col("date") == days[-1].date()).collect())

    def weighed(values):
        return sum(x * (i + 1) for i, x in enumerate(values))

    before = [10004.0 + n for n in range(35)]
    allowed = [[before + [10039.0], before + [10039.0, 0.5]], [before + [0.5], before + [0.5, 10039.0]]]
    assert got in [sorted(weighed(w[-5:]) for w in both) for both in allowed]


def test_means_round_as_in_the_statement(spark):
    rng = random.Random(6)
    values = [11581.577262499999, 3282.5968374999998, 4110.3706925, 4216.4402125, -4110.3706925, 0.0, None] + [rng.randrange(10**9, 10**11) / 1e6 + 5e-7 for _ in range(3000)]
    got = [r.x for r in spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double").select("i", *times6("x")).orderBy("i").collect()]
    c = duckdb.connect()
    assert got == [c.execute("select round(?::double, 6)", [x]).fetchone()[0] for x in values]


def _in_some_order(rows, f, got):
    """Whether ``got`` is what ``f`` gives for the rows in one of the orders that their days allow."""
    days = [list(itertools.permutations(g)) for _, g in itertools.groupby(sorted(rows), key=lambda r: r[0])]
    return any(f([r for part in order for r in part]) == got for order in itertools.product(*days))


def test_rows_of_one_day_stand_in_one_order(spark):
    """Several rows of a code on a day may come in any order, but in the same one for all that a query works out."""
    rows = [(0, 10.0), (0, 13.0), (1, 11.0), (2, 17.0), (2, 9.0), (3, 12.0), (4, 8.0), (4, 19.0), (5, 10.0)]

    def ema(values, span):
        out = [values[0]]
        for x in values[1:]:
            out.append(out[-1] + 2 / (span + 1) * (x - out[-1]))
        return out

    def macd(rs):
        fast, slow = (ema([x for _, x in rs], n) for n in (3, 5))
        return sorted((d, x, round(a - b, 9) + 0.0) for (d, x), a, b in zip(rs, fast, slow))

    def adjusted(rs):
        ratios = [1.0] + [(x - 1) / before for (_, before), (_, x) in zip(rs, rs[1:])]
        return sorted((d, x, round(x * math.prod(ratios[i + 1 :]), 9)) for i, (d, x) in enumerate(rs))

    for seed in range(4):
        mixed = random.Random(seed).sample(rows, len(rows))
        df = spark.createDataFrame([("a", day(d + 1), x, x, x, x, x - 1, 1) for d, x in mixed], "code string, date date, open double, high double, low double, close double, preclose double, tradestatus int").repartition(1)
        at = {day(d + 1): d for d, _ in rows}
        got = sorted((at[r.date], r.close, round(r.macd, 9) + 0.0) for r in indicators.macd(df, 3, 5, 2).collect())
        assert _in_some_order(rows, macd, got)
        got = sorted((at[r.date], r.close, round(r.adjusted, 9)) for r in bars.adjust_qfq(df.withColumn("x", F.col("close"))).select("date", F.col("x").alias("close"), F.col("close").alias("adjusted")).collect())
        assert _in_some_order(rows, adjusted, got)
