"""Technical indicators per code, as expressions over windows; recursions are running sums over blocks of rows."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import price_limit


def by_code(order: str | list[str] = "date") -> Window:
    return Window.partitionBy("code").orderBy(*([order] if isinstance(order, str) else order))


def full_frame(c: Column, n: int, order: str | list[str] = "date") -> Column:
    """A value over the last n rows, null until there are n."""
    w = by_code(order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(F.lit(1)).over(w) == n, c.over(w))


def sma(df: DataFrame, windows: tuple[int, ...] = (5, 10, 20, 30, 60), value: str = "close") -> DataFrame:
    return df.withColumns({f"ma{n}": full_frame(F.avg(value), n) for n in windows})


def bollinger(df: DataFrame, n: int = 20, width: float = 2.0, value: str = "close") -> DataFrame:
    mid, sd = full_frame(F.avg(value), n), full_frame(F.stddev_pop(value), n)
    return df.withColumns({"boll_up": mid + width * sd, "boll_mid": mid, "boll_low": mid - width * sd})


def is_new(df: DataFrame, gap: int = 30, span: int = 5, index: str = "trade_date_idx") -> DataFrame:
    """1 on a code's first row, and on ``span`` rows from each jump of the calendar index above ``gap``."""
    w = by_code(index)
    jump = F.when(F.col(index) - F.lag(index).over(w) > gap, 1).otherwise(0)
    df = df.withColumn("_jump", jump).withColumn("_first", F.row_number().over(w))
    flag = (F.col("_first") == 1) | (F.max("_jump").over(w.rowsBetween(-(span - 1), 0)) == 1)
    return df.withColumn("is_new", flag.cast("int")).drop("_jump", "_first")


class Smooth(NamedTuple):
    """y = keep * y before + (1 - keep) * x from the row after ``start`` (counted from 0) on; there y is ``init``, by default x."""

    x: Column
    keep: float
    start: Column | int = 0
    init: Column | None = None


def _blocks(df: DataFrame, order: list[str], keeps: list[float]) -> tuple[DataFrame, int]:
    """Numbers the rows of a code and deals them into blocks so long that what was before a block is below 1e-17 of a value after the next one."""
    size = max(math.ceil(40 / -math.log(k)) for k in keeps)
    n = F.row_number().over(by_code(order)) - 1
    return df.withColumn("_n", n).withColumn("_block", F.floor(F.col("_n") / size)), size


def _smooth(df: DataFrame, size: int, parts: dict[str, Smooth]) -> DataFrame:
    """The smoothings as expressions: a step is a map y -> keep * y + z, and such maps compose, within a block by one running sum.

    In a block y is keep^i times the running sum of z / keep^i, i the row's place in it, plus keep^(i + 1) times the last y of the
    block before, of which only that block's own rows still count. From a row without a value on, y is null. All go by the rows' numbers,
    so that rows which tie in the order they were numbered by stand in the same order in every window.
    """
    inside, whole = Window.partitionBy("code", "_block").orderBy("_n"), Window.partitionBy("code").orderBy("_n")
    so_far, before = whole.rowsBetween(Window.unboundedPreceding, 0), whole.rowsBetween(Window.unboundedPreceding, -1)
    i = (F.col("_n") % size).cast("double")
    step, lost, y = {}, {}, {}
    for name, p in parts.items():
        start = p.start if isinstance(p.start, Column) else F.lit(p.start)
        z = F.when(F.col("_n") == start, p.x if p.init is None else p.init).when(F.col("_n") > start, p.x * (1 - p.keep))
        step |= {f"_z_{name}": z, f"_lost_{name}": (F.col("_n") >= start) & z.isNull(), f"_on_{name}": F.col("_n") >= start}
    df = df.withColumns(step)
    for name, p in parts.items():
        lost |= {f"_sum_{name}": F.coalesce(F.sum(F.col(f"_z_{name}") / F.pow(F.lit(p.keep), i)).over(inside), F.lit(0.0)) * F.pow(F.lit(p.keep), i)}
    df = df.withColumns(lost)
    for name, p in parts.items():
        end = F.last(F.when(F.col("_n") % size == size - 1, F.col(f"_sum_{name}")), True).over(before)
        y[name] = F.when(F.col(f"_on_{name}") & (F.count_if(F.col(f"_lost_{name}")).over(so_far) == 0), F.col(f"_sum_{name}") + F.coalesce(end, F.lit(0.0)) * F.pow(F.lit(p.keep), i + 1))
    return df.withColumns(y).drop(*[f"_{c}_{name}" for name in parts for c in ("z", "lost", "on", "sum")])


def _ema(x: Column, span: int, before: Column | None = None) -> Smooth:
    keep = 1 - 2 / (span + 1)
    return Smooth(x, keep, 0, None if before is None else F.coalesce(before * keep + x * (1 - keep), x))


def _macd_parts(fast: int, slow: int, before: str | None = None) -> dict[str, Smooth]:
    at = (lambda c: F.col(f"_before.{c}")) if before else lambda c: None
    return {"_fast": _ema(F.col("close"), fast, at("ema_fast")), "_slow": _ema(F.col("close"), slow, at("ema_slow"))}


def _keeps(*spans: int) -> list[float]:
    return [1 - 2 / (s + 1) for s in spans]


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, order: tuple[str, ...] = ("date",), state: DataFrame | None = None, with_state: bool = False) -> DataFrame:
    """macd, macd_signal and macd_hist. ``with_state`` adds ema_fast and ema_slow; a code's last row of these and macd_signal is what ``state`` (code,
    ema_fast, ema_slow, macd_signal) continues from, so that only new rows have to be read."""
    order = list(order)
    if state is not None:
        df = df.join(state.select("code", F.struct("ema_fast", "ema_slow", "macd_signal").alias("_before")), "code", "left")
    d, size = _blocks(df, order, _keeps(fast, slow, signal))
    d = _smooth(d, size, _macd_parts(fast, slow, None if state is None else "_before")).withColumn("macd", F.col("_fast") - F.col("_slow"))
    d = _smooth(d, size, {"macd_signal": _ema(F.col("macd"), signal, None if state is None else F.col("_before.macd_signal"))})
    d = d.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    if with_state:
        d = d.withColumns({"ema_fast": F.col("_fast"), "ema_slow": F.col("_slow")})
    return d.drop("_fast", "_slow", "_n", "_block", "_before")


def _rsi_parts(n: int) -> dict[str, Smooth]:
    """Mean rise and fall: over the first n steps, then smoothed. Needs the columns of _with_steps."""
    return {c: Smooth(F.col(f"_step{c}"), (n - 1) / n, n, F.col(f"_mean{c}")) for c in ("_up", "_down")}


def _with_steps(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    move = F.col("close") - F.lag("close").over(by_code(order))
    df = df.withColumns({"_step_up": F.when(move.isNotNull(), F.greatest(move, F.lit(0.0))), "_step_down": F.when(move.isNotNull(), F.greatest(-move, F.lit(0.0)))})
    first = by_code(order).rowsBetween(-(n - 1), 0)
    return df.withColumns({f"_mean{c}": F.when(F.count(f"_step{c}").over(first) == n, F.avg(f"_step{c}").over(first)) for c in ("_up", "_down")})


def _strength() -> Column:
    return 100 - 100 / (1 + F.col("_up") / F.when(F.col("_down") == 0, 1e-10).otherwise(F.col("_down")))


_STEPS = ("_step_up", "_step_down", "_mean_up", "_mean_down", "_up", "_down")


def rsi(df: DataFrame, n: int = 14, order: tuple[str, ...] = ("date",), name: str = "rsi") -> DataFrame:
    order = list(order)
    d, size = _blocks(_with_steps(df, n, order), order, [(n - 1) / n])
    return _smooth(d, size, _rsi_parts(n)).withColumn(name, _strength()).drop(*_STEPS, "_n", "_block")


def _position(n: int, order: list[str]) -> Column:
    """Where the close lies between the lows and highs of n rows."""
    hi, lo = full_frame(F.max("high"), n, order), full_frame(F.min("low"), n, order)
    return F.when(hi == lo, 50.0).otherwise((F.col("close") - lo) / F.nullif(hi - lo, F.lit(0.0)) * 100)


def _kdj_part(x: str, n: int, m: int) -> Smooth:
    return Smooth(F.col(x), (m - 1) / m, n - 1, F.lit(50.0))


def kdj(df: DataFrame, n: int = 9, m1: int = 3, m2: int = 3, order: tuple[str, ...] = ("date",)) -> DataFrame:
    """The n-row position comes from window frames, K smooths it and D smooths K."""
    order = list(order)
    d, size = _blocks(df.withColumn("_rsv", _position(n, order)), order, [(m1 - 1) / m1, (m2 - 1) / m2])
    d = _smooth(_smooth(d, size, {"k": _kdj_part("_rsv", n, m1)}), size, {"d": _kdj_part("k", n, m2)})
    return d.withColumn("j", 3 * F.col("k") - 2 * F.col("d")).drop("_rsv", "_n", "_block")


def daily_features(bars: DataFrame) -> DataFrame:
    """All technical columns of a code-day: frames first, then what recurs, in two steps of running sums over blocks that all share."""
    df = is_new(bars)
    df = df.withColumn("price_limit", price_limit(F.col("code"), F.col("isST"), F.col("is_new")))
    df = bollinger(sma(df)).withColumn("_rsv", _position(9, ["date"]))
    d, size = _blocks(_with_steps(df, 14, ["date"]), ["date"], [*_keeps(12, 26, 9), 13 / 14, 2 / 3])
    d = _smooth(d, size, _macd_parts(12, 26) | _rsi_parts(14) | {"k": _kdj_part("_rsv", 9, 3)}).withColumns({"macd": F.col("_fast") - F.col("_slow"), "rsi": _strength()})
    d = _smooth(d, size, {"macd_signal": _ema(F.col("macd"), 9), "d": _kdj_part("k", 9, 3)})
    return d.withColumns({"macd_hist": F.col("macd") - F.col("macd_signal"), "j": 3 * F.col("k") - 2 * F.col("d")}).drop(*_STEPS, "_rsv", "_fast", "_slow", "_n", "_block")


def m15_features(m15: DataFrame) -> DataFrame:
    """RSI and KDJ over a code's intraday bars in order, running on across days."""
    order = ["date", "slot"]
    d, size = _blocks(_with_steps(m15.withColumn("_rsv", _position(9, order)), 14, order), order, [13 / 14, 2 / 3])
    d = _smooth(d, size, _rsi_parts(14) | {"k": _kdj_part("_rsv", 9, 3)}).withColumn("rsi", _strength())
    d = _smooth(d, size, {"d": _kdj_part("k", 9, 3)})
    return d.withColumn("j", 3 * F.col("k") - 2 * F.col("d")).drop(*_STEPS, "_rsv", "_n", "_block")


def pivot_m15(m15: DataFrame, slots: list[int], fields: list[str]) -> DataFrame:
    """One row per code-day with m15_{slot}_{field}; the last non-null value of a cell."""
    aggs = [F.last(f, True).alias(f) for f in fields]
    wide = m15.groupBy("code", "date").pivot("slot", slots).agg(*aggs)
    if len(fields) == 1:
        return wide.select("code", "date", *[F.col(str(s)).alias(f"m15_{s}_{fields[0]}") for s in slots])
    return wide.select("code", "date", *[F.col(f"{s}_{f}").alias(f"m15_{s}_{f}") for s in slots for f in fields])
