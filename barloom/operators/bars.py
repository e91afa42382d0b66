"""Daily bars: order, repair, adjustment, share counts, corporate actions, suspensions."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import days_between
from ..functions.columns import is_st_name


def history(partition: str = "code", order: str = "date") -> Window:
    return Window.partitionBy(partition).orderBy(order)


def dedupe_by_key(df: DataFrame, keys: list[str], order: list[Column], keep: str = "last") -> DataFrame:
    """One row per key, the first or last in the stated order."""
    by = order if keep == "first" else [o for o in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    if keep == "last":
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(o) if isinstance(o, str) else o.desc() for o in order]))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def normalise_idle(df: DataFrame) -> DataFrame:
    traded = F.coalesce(F.col("volume") > 0, F.lit(False))
    return df.withColumns({"volume": F.when(traded, F.col("volume")).otherwise(0), "amount": F.when(traded, F.col("amount")).otherwise(0), "turn": F.when(traded, F.col("turn")), "pctChg": F.when(traded, F.col("pctChg"))})


def fill_turn(bars: DataFrame, shares: DataFrame) -> DataFrame:
    """Turnover from the latest share count (ten-thousands) at or before each traded day, by one union and window."""
    both = bars.select("code", "date", "volume", "tradestatus", F.lit(None).cast("double").alias("shares_wan"), F.lit(1).alias("kind")).unionByName(
        shares.select("code", "date", F.lit(None).cast("double").alias("volume"), F.lit(None).cast("int").alias("tradestatus"), "shares_wan", F.lit(0).alias("kind"))
    )
    w = Window.partitionBy("code").orderBy("date", "kind").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("shares", F.last("shares_wan", True).over(w)).where("kind = 1")
    return both.select("code", "date", F.when(F.col("tradestatus") == 1, F.try_divide(F.col("volume"), F.col("shares") * 1e4) * 100).alias("turn"))


def action_sums(actions: DataFrame) -> DataFrame:
    """Dividend, bonus, allotment and allotment value per share, summed over a code's ex-day."""
    return actions.groupBy("code", "ex_date").agg(
        F.sum("dividend_per_share").alias("d"), F.sum("per_share_bonus").alias("b"), F.sum("allotment_ratio").alias("r"), F.sum(F.col("allotment_ratio") * F.col("allotment_price")).alias("rp")
    )


def reference_price(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """preclose and pctChg of each row: the last traded close, adjusted for the actions since then, HALF_UP to 0.01.

    Actions are matched by code with an ex-day after the previous traded day and up to this one. One ex-day is worked out in
    decimals, so that half a cent rounds up; several multiply as factors. The first traded row takes its supplied preclose as base.
    """
    w = history()
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    traded = F.col("tradestatus") == 1
    df = bars.withColumn("base", F.last(F.when(traded, F.col("close")), True).over(before)).withColumn("since", F.last(F.when(traded, F.col("date")), True).over(before))
    df = df.withColumn("base", F.coalesce("base", "preclose")).withColumn("since", F.coalesce("since", F.date_sub("date", 1)))
    # an action counts on the first traded day at or after its ex-day: both sorted together, latest first, a traded day ahead of the actions of that day
    a = action_sums(actions).select("code", F.col("ex_date").alias("date"), F.lit(1).alias("kind"), F.struct("d", "b", "r", "rp").alias("a"))
    both = a.unionByName(df.where(traded).select("code", "date", F.lit(0).alias("kind")), allowMissingColumns=True)
    latest = Window.partitionBy("code").orderBy(F.desc("date"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("_on", F.last(F.when(F.col("kind") == 0, F.col("date")), True).over(latest)).where("kind = 1 and _on is not null")
    met = met.select(F.col("code").alias("a_code"), "_on", F.col("date").alias("ex_date"), "a.*")
    hit = df.where(traded).join(met, (F.col("code") == F.col("a_code")) & (F.col("date") == F.col("_on"))).where(F.col("ex_date") > F.col("since"))
    factor = (F.col("base") - F.col("d") + F.col("rp")) / (1 + F.col("b") + F.col("r")) / F.col("base")
    base, d, b, r, rp = (F.col(c).cast(f"decimal({p},{s})") for c, p, s in (("base", 20, 9), ("d", 18, 9), ("b", 12, 9), ("r", 12, 9), ("rp", 18, 9)))
    one = F.try_divide(base - d + rp, F.lit(1).cast("decimal(12,9)") + b + r).cast("double")
    factors = hit.groupBy("code", "date").agg(F.product(factor).alias("factor"), F.when(F.count(F.lit(1)) == 1, F.max(one)).alias("one"))
    df = df.join(factors, ["code", "date"], "left")
    ref = F.when(F.col("factor").isNull(), F.col("base")).otherwise(F.round(F.coalesce("one", F.col("base") * F.col("factor")).cast("decimal(38,12)"), 2).cast("double"))
    df = df.withColumn("preclose", F.when(traded, ref).otherwise(F.col("close")))
    return df.withColumn("pctChg", F.when(traded, (F.try_divide(F.col("close"), F.col("preclose")) - 1) * 100)).drop("base", "since", "factor", "one")


def adjust_qfq(bars: DataFrame, mode: str = "qfq") -> DataFrame:
    """Forward-adjusted prices: each row times the product of all later ex-right ratios of its code."""
    if mode == "raw":
        return bars
    w = history()
    traded = F.col("tradestatus") == 1
    last = F.last(F.when(traded, F.col("close")), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    ratio = F.when(traded & (F.col("preclose") > 0) & (last > 0), F.col("preclose") / last)
    ratio = F.when(F.abs(ratio - 1) > 1e-10, ratio).otherwise(1.0)
    # backwards by the rows' numbers, so that rows of one day stand in the same order both ways
    later = Window.partitionBy("code").orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, -1)
    df = bars.withColumns({"_ratio": F.coalesce(ratio, F.lit(1.0)), "_i": F.row_number().over(w)}).withColumn("qfq_factor", F.coalesce(F.product("_ratio").over(later), F.lit(1.0))).drop("_ratio", "_i")
    return df.withColumns({c: F.col(c) * F.col("qfq_factor") for c in ("open", "high", "low", "close", "preclose")})


def carry_prices(df: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Idle rows get the last traded close before them, else their own positive price, else the code's base close."""
    traded = F.col("tradestatus") == 1
    last = F.last(F.when(traded, F.col("close")), True).over(history().rowsBetween(Window.unboundedPreceding, -1))
    df = df.join(base, "code", "left") if base is not None else df.withColumn("base_close", F.lit(None).cast("double"))
    carry = F.coalesce(last, F.when(F.col("close") > 0, F.col("close")), F.col("base_close"))
    df = df.withColumn("_carry", carry)
    return df.withColumns({c: F.when(traded, F.col(c)).otherwise(F.col("_carry")) for c in ("open", "high", "low", "close", "preclose")}).drop("_carry", "base_close")


def base_close(bars: DataFrame, floor: str) -> DataFrame:
    """Last close before the first day of the store, per code; null where there is none."""
    early = bars.where(F.col("date") < F.to_date(F.lit(floor))).groupBy("code").agg(F.max_by("close", "date").alias("base_close"))
    return bars.select("code").distinct().join(early, "code", "left")


def densify(bars: DataFrame, calendar: DataFrame, master: DataFrame, target: str, published_today: bool = True) -> DataFrame:
    """A row for every code and trading day from its first row or listing to the target, delisting or calendar end; rows beyond stay.

    ``master``: code, list_date, delist_date and, if known, list_status: delisted (D) and paused (P) codes without a date end with their
    last traded row. A code without a master row counts as listed. The days of each code are laid out from its position in the calendar.
    """
    status = F.col("list_status") if "list_status" in master.columns else F.lit("L")
    master = master.select("code", "list_date", "delist_date", F.coalesce(status, F.lit("L")).alias("list_status"))
    span = bars.groupBy("code").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.max(F.when(F.col("tradestatus") == 1, F.col("date"))).alias("last_traded"))
    goal = F.to_date(F.lit(target))
    end = F.least(F.coalesce("delist_date", goal), goal if published_today else F.date_sub(goal, 1))
    end = F.when(F.col("delist_date").isNull() & F.col("list_status").isin("D", "P"), F.least(end, F.coalesce("last_traded", end))).otherwise(end)
    codes = span.join(master, "code", "left").withColumn("list_status", F.coalesce("list_status", F.lit("L")))
    codes = codes.select("code", "last", F.least("first", F.coalesce("list_date", "first")).alias("lo"), end.alias("hi"))
    codes = codes.withColumn("hi", F.when(F.col("hi") < F.col("lo"), F.col("last")).otherwise(F.col("hi")))
    days = days_between(codes, calendar, F.col("lo"), F.col("hi")).select("code", "date")
    out = days.join(bars, ["code", "date"], "full")
    out = out.withColumn("tradestatus", F.coalesce("tradestatus", F.lit(0))).withColumn("volume", F.coalesce("volume", F.lit(0)))
    return normalise_idle(carry_prices(out))


def simple_return(df: DataFrame) -> DataFrame:
    return df.withColumn("ret1", F.col("close") / F.lag("close").over(history()) - 1)


def trailing_suspension(bars: DataFrame, look_back: int = 500) -> DataFrame:
    """First day of the idle run that ends a code's history; codes that end with trading do not appear."""
    recent = F.row_number().over(Window.partitionBy("code").orderBy(F.desc("date"))) <= look_back
    df = bars.withColumn("_r", recent).where("_r").drop("_r")
    stop = F.max(F.when(F.col("tradestatus") != 0, F.col("date"))).over(Window.partitionBy("code"))
    run = df.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col("date") > F.col("_stop")))
    return run.groupBy("code").agg(F.min("date").alias("suspended_since"))


def suspended_runs(events: DataFrame, calendar: DataFrame, anchor: str) -> DataFrame:
    """(code, start, end): the calendar-contiguous run of suspension days that holds a code's latest one.

    Codes whose latest announced day lies before the anchor trade again and drop; a day announced beyond the anchor decides, whatever there is at it.
    """
    df = events.select("code", "date").distinct().join(F.broadcast(calendar), "date")
    island = F.col("tdi") - F.row_number().over(Window.partitionBy("code").orderBy("tdi"))
    runs = df.withColumn("_i", island).groupBy("code", "_i").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    last = runs.groupBy("code").agg(F.max_by(F.struct("start", "end"), "end").alias("r")).select("code", "r.start", "r.end")
    return last.where(F.col("end") >= F.to_date(F.lit(anchor)))


def suspension_batch(status: DataFrame) -> DataFrame:
    """What merge_suspensions takes, from raw rows (code, date, tradestatus): code, start, resumed, traded_before.

    A code whose latest row traded has resumed; else its run starts after its last traded row, or with its first. Rows without a code
    or a date drop, a status that is no number counts as traded.
    """
    d = status.select(F.trim(F.col("code").cast("string")).alias("code"), F.try_to_date(F.col("date").cast("string")).alias("date"), F.coalesce(F.col("tradestatus").try_cast("int"), F.lit(1)).alias("status"))
    d = d.where((F.col("code") != "") & F.col("date").isNotNull())
    stop = F.max(F.when(F.col("status") != 0, F.struct("date", "status"))).over(Window.partitionBy("code"))["date"]
    g = d.withColumn("_stop", stop).groupBy("code").agg(F.max_by("status", F.struct("date", "status")).alias("_last"), F.min(F.when(F.col("_stop").isNull() | (F.col("date") > F.col("_stop")), F.col("date"))).alias("start"), F.first("_stop").isNotNull().alias("traded_before"))
    resumed = F.col("_last") != 0
    return g.select("code", F.when(~resumed, F.col("start")).alias("start"), resumed.alias("resumed"), (F.col("traded_before") & ~resumed).alias("traded_before"))


def silent_codes(asked: DataFrame, status: DataFrame, today: str, most_days: int = 30) -> DataFrame:
    """Codes asked for over more than ``most_days`` days without a single row count as suspended; a batch like suspension_batch's.

    ``asked``: code, days, date (the start to note; null: today).
    """
    none = asked.where((F.col("days") > most_days) & (F.trim("code") != "")).join(status.select("code").distinct(), "code", "left_anti")
    start = F.coalesce("date", F.to_date(F.lit(today)))
    return none.groupBy("code").agg(F.min(start).alias("start")).select("code", "start", F.lit(False).alias("resumed"), F.lit(False).alias("traded_before"))


def merge_suspensions(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """Ledger and batch hold (code, start); batch also ``resumed`` and ``traded_before`` flags.

    A resumed code leaves; a run with trading before it in the batch replaces the start; otherwise the earlier start stays.
    """
    b = batch.select(F.col("code").alias("b_code"), F.col("start").alias("b_start"), "resumed", "traded_before")
    both = ledger.join(b, F.col("code") == F.col("b_code"), "full")
    start = F.when(F.coalesce("traded_before", F.lit(False)), F.col("b_start")).otherwise(F.least("start", "b_start"))
    return both.where(~F.coalesce("resumed", F.lit(False))).select(F.coalesce("code", "b_code").alias("code"), start.alias("start"))


def fill_status(df: DataFrame, names: DataFrame | None = None, target: str | None = None) -> DataFrame:
    """isST carried forward, 0 before the first known value; on the target day by the current name (``names``: code, name) where there is one."""
    if names is not None:
        by_name = names.select("code", is_st_name(F.col("name")).cast("int").alias("_st"))
        return fill_status(df).join(by_name, "code", "left").withColumn("isST", F.when(F.col("date") == F.to_date(F.lit(target)), F.coalesce("_st", "isST")).otherwise(F.col("isST"))).drop("_st")
    return df.withColumn("isST", F.coalesce(F.last("isST", True).over(history().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))


def name_changes(snapshots: DataFrame) -> DataFrame:
    """Codes in both of the two latest snapshots whose name differs; codes that left before are no news."""
    snaps = snapshots.select("snap").distinct().withColumn("_n", F.row_number().over(Window.orderBy(F.desc("snap"))))  # a row for each snapshot
    d = snapshots.join(F.broadcast(snaps.where("_n <= 2")), "snap")
    names = d.groupBy("code").agg(F.max(F.when(F.col("_n") == 2, F.col("name"))).alias("old_name"), F.max(F.when(F.col("_n") == 1, F.col("name"))).alias("name"))
    return names.where("old_name <> name")


def listed_without_bar(master: DataFrame, bars: DataFrame, anchor: str) -> DataFrame:
    """Listed codes without a bar on the anchor day, or on the latest day before it that has bars."""
    day = bars.where(F.col("date") <= F.to_date(F.lit(anchor))).agg(F.max("date").alias("day"))
    there = bars.join(F.broadcast(day), F.col("date") == F.col("day"), "left_semi").select("code").distinct()
    return master.where("list_status = 'L'").join(there, "code", "left_anti").select("code")


def priority_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Source a from its first day on; b only before it."""
    first = a.groupBy("code").agg(F.min("date").alias("_first"))
    old = b.join(first, "code", "left").where(F.col("_first").isNull() | (F.col("date") < F.col("_first"))).drop("_first")
    return a.unionByName(old)


def align_series(series: dict[str, DataFrame]) -> DataFrame:
    """(date, value) series side by side, over the union of their days."""
    parts = [df.select("date", F.lit(name).alias("_name"), "value") for name, df in series.items()]
    return functools.reduce(DataFrame.unionByName, parts).groupBy("date").pivot("_name", list(series)).agg(F.last("value", True))


def overlay(df: DataFrame, legacy: DataFrame, cols: list[str]) -> DataFrame:
    """On traded rows a legacy value that is not null replaces the derived one."""
    old = legacy.select("code", "date", *[F.col(c).alias(f"_old_{c}") for c in cols])
    out = df.join(old, ["code", "date"], "left")
    traded = F.col("tradestatus") == 1
    return out.withColumns({c: F.when(traded, F.coalesce(f"_old_{c}", c)).otherwise(F.col(c)) for c in cols}).drop(*[f"_old_{c}" for c in cols])


def snapshot_diff(previous: DataFrame, current: DataFrame, bars: DataFrame) -> DataFrame:
    """Codes that left the master, with their last bar day; codes that came back as such."""
    last = bars.groupBy("code").agg(F.max("date").alias("last_date"))
    gone = previous.join(current, "code", "left_anti").join(last, "code", "left").select("code", "last_date", F.lit("left").alias("change"))
    new = current.join(previous, "code", "left_anti").select("code", F.lit(None).cast("date").alias("last_date"), F.lit("joined").alias("change"))
    return gone.unionByName(new)
