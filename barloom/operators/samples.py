"""Training samples: windows, gates, tails, materialisation, splits, epoch order and batches."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import null_to_zero
from .bars import dedupe_by_key
from .order import kept, numbered
from .rows import subsample


def lookup_with_default(df: DataFrame, side: DataFrame, keys: list[str], default: float, order: list[Column | str] | None = None) -> DataFrame:
    """Left lookup of one side row per key; misses take the default.

    Of several rows of a key the first in ``order`` counts, without one that with the smallest values, column by column. What the order names and is
    not a key is looked up as well, unless it is a column of ``df``.
    """
    cols = [c for c in side.columns if c not in keys]
    one = dedupe_by_key(side, keys, [F.col(c) if isinstance(c, str) else c for c in (order or cols or keys)], "first")
    cols = [c for c in cols if c not in df.columns]
    return df.join(one.select(*keys, *cols), keys, "left").withColumns({c: F.coalesce(c, F.lit(default)) for c in cols})


def full_windows(df: DataFrame, length: int) -> DataFrame:
    """Rows that end a window of so many rows of their code."""
    n = F.row_number().over(Window.partitionBy("code").orderBy("date"))
    return df.withColumn("_n", n).where(F.col("_n") >= length).drop("_n")


def sample_ids(df: DataFrame, feature_len: int, horizon: int, lo: str, hi: str) -> DataFrame:
    """Windows of feature_len + horizon rows, named by their last row, whose date is in [lo, hi)."""
    return full_windows(df, feature_len + horizon).where((F.col("date") >= F.to_date(F.lit(lo))) & (F.col("date") < F.to_date(F.lit(hi)))).select("code", "date")


def bad_rows(df: DataFrame, m15: tuple[str, ...] = ()) -> Column:
    """Whether a row spoils the windows that hold it: special treatment, a new listing, or 15-minute data that are not there.

    With a column m15_complete that must be above 0; else a row that traded (volume above 0) must have all ``m15`` columns finite. Idle rows
    may lack them. isST and is_new count where the frame has them.
    """
    bad = [F.coalesce(F.col(c) != 0, F.lit(False)) for c in ("isST", "is_new") if c in df.columns]
    if "m15_complete" in df.columns:
        bad.append(F.coalesce(F.col("m15_complete") <= 0, F.lit(False)))
    else:
        traded = F.coalesce(F.col("volume") > 0, F.lit(False)) if "volume" in df.columns else F.lit(True)
        bad += [traded & ~F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False)) for c in m15]
    return functools.reduce(lambda a, b: a | b, bad, F.lit(False))


def gate_windows(df: DataFrame, bad: str, length: int) -> DataFrame:
    """Rows that end a full window without a bad row."""
    w = Window.partitionBy("code").orderBy("date").rowsBetween(-(length - 1), 0)
    d = df.withColumn("_bad", F.sum(F.col(bad).cast("int")).over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
    return d.where((F.col("_bad") == 0) & (F.col("_n") == length)).drop("_bad", "_n")


def tail_samples(df: DataFrame, bad: str, length: int, lo_tdi: int, hi_tdi: int) -> DataFrame:
    """One virtual sample per code whose last row is the market's last day: the target is that row one day later."""
    last = df.agg(F.max("trade_date_idx").alias("_last"))
    d = gate_windows(df, bad, length - 1).crossJoin(F.broadcast(last)).where("trade_date_idx = _last").drop("_last")
    d = d.withColumn("trade_date_idx", F.col("trade_date_idx") + 1).withColumn("virtual", F.lit(True))
    return d.where((F.col("trade_date_idx") >= lo_tdi) & (F.col("trade_date_idx") < hi_tdi))


def _windows(rows: pa.Table, ids: pa.Table, cols: list[str], length: int) -> pa.Table:
    """Slices of a code's ordered rows that end on the days asked for."""
    day = np.asarray(rows.column("date").cast(pa.int32()))
    order = np.argsort(day, kind="stable")
    asked = np.unique(np.asarray(ids.column("date").cast(pa.int32())))
    at = np.flatnonzero(np.isin(day[order], asked)) if len(day) else np.empty(0, int)
    begin = np.maximum(at - length + 1, 0)
    sizes = at + 1 - begin
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    places = order[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], sizes)] if len(at) else np.empty(0, int)
    out = {"code": rows.column("code").take(pa.array(order[at])), "date": rows.column("date").take(pa.array(order[at]))}
    for c in cols:
        values = np.asarray(rows.column(c).combine_chunks().cast(pa.float64()))
        out[c] = pa.ListArray.from_arrays(pa.array(ends), pa.array(values[places]))
    return pa.table(out)


def materialise(ids: DataFrame, daily: DataFrame, length: int, cols: list[str], sides: tuple[tuple[DataFrame, tuple[str, ...], float], ...] = ()) -> DataFrame:
    """One array per column of the window's rows in order; non-finite values become 0, unknown columns are ignored.

    ``sides``: further tables with their keys and the value of rows they lack; their columns are joined to the daily rows first. A code's rows,
    which the calendar bounds, meet its ids in one call, and only the windows asked for are made; codes without an id do not travel.
    """
    ids = ids.select("code", "date").distinct()
    daily = daily.join(ids.select("code").distinct(), "code", "left_semi")
    for side, keys, default in sides:
        daily = lookup_with_default(daily, side.select(*keys, *[c for c in cols if c in side.columns and c not in daily.columns]), list(keys), default)
    cols = [c for c in cols if c in daily.columns]
    d = daily.select("code", "date", *[null_to_zero(F.col(c).cast("double")).alias(c) for c in cols])
    schema = f"code {d.schema['code'].dataType.simpleString()}, date date, " + ", ".join(f"`{c}` array<double>" for c in cols)
    return d.groupBy("code").cogroup(ids.groupBy("code")).applyInArrow(lambda rows, asked: _windows(rows, asked, cols, length), schema.rstrip(", "))


def split_samples(ids: DataFrame, begin: str, split: str, end: str, calendar: DataFrame | None = None, exclusive: bool = False) -> DataFrame:
    """train [begin, split] and validation [split, end]; the split day is in both, or with ``exclusive`` in train only.

    With a calendar the validation ends on the next trading day after the end (on the end itself, if there is none).
    """
    day = F.col("date")
    b, s, e = (F.to_date(F.lit(x)) for x in (begin, split, end))
    if calendar is not None:
        after = calendar.agg(F.coalesce(F.min(F.when(F.col("date") > e, F.col("date"))), e).alias("_end"))
        ids, e = ids.crossJoin(F.broadcast(after)), F.col("_end")
    parts = F.array_compact(F.array(F.when((day >= b) & (day <= s), F.lit("train")), F.when((day > s if exclusive else day >= s) & (day <= e), F.lit("validation"))))
    return ids.withColumn("split", F.explode(parts)).drop("_end")


def train_and_validation(df: DataFrame, feature_len: int, horizon: int, begin: str, split: str, end: str, calendar: DataFrame, train_horizon: int | None = None, ratios: tuple[float, float] = (1.0, 1.0), exclusive: bool = False, seed: int = 0) -> DataFrame:
    """(code, date, trade_date_idx, split): full windows of each side with its own horizon; of a side below ratio 1 a share of each code's.

    ``df``: code, date, trade_date_idx. A target day may lie anywhere in the side's days, so windows reach back beyond its begin.
    """
    sides = []
    for side, length, ratio in (("train", train_horizon or horizon, ratios[0]), ("validation", horizon, ratios[1])):
        d = full_windows(df.select("code", "date", "trade_date_idx"), feature_len + length)
        d = split_samples(d, begin, split, end, calendar, exclusive).where(F.col("split") == side)
        sides.append(subsample(d, ratio, seed) if ratio < 1 else d)
    return sides[0].unionByName(sides[1])


def epoch_order(ids: DataFrame, seed: int, epoch: int, start: int = 0, shard_rows: int = 100_000) -> DataFrame:
    """The epoch's samples from the place ``start`` on: a hash of sample, seed and epoch orders them, ``place`` counts through the epoch.

    Shards hold ``shard_rows`` places each, so there are as many as the samples need.
    """
    h = F.xxhash64("code", "date", F.lit(seed + epoch))
    d = numbered(kept(ids.withColumn("_h", h), "epoch"), "_h", "code", "date", rows_per_part=shard_rows)
    return d.withColumn("shard", F.floor(F.col("place") / shard_rows)).where(F.col("place") >= start).drop("_h")


def ordered_batches(ids: DataFrame, size: int, seed: int | None = None, drop_last: bool = False, skip: int = 0, limit: int | None = None) -> DataFrame:
    """Batches through all days: samples by (date, code), or in a seeded order, ``size`` at a time; the first ``skip`` go and ``limit`` stay."""
    d = kept(ids.withColumn("_h", F.lit(0).cast("long") if seed is None else F.xxhash64("code", "date", F.lit(seed))), "batches")
    full = d.count() // size
    d = numbered(d, "_h", "date", "code", place="_i").withColumn("batch", F.floor(F.col("_i") / size))
    if drop_last:
        d = d.where(F.col("batch") < full)
    if skip:
        d = d.where(F.col("batch") >= skip)
    if limit is not None:
        d = d.where(F.col("batch") < skip + limit)
    return d.drop("_h", "_i")


def batch_count(n_samples: int, size: int, drop_last: bool = False) -> int:
    return n_samples // size if drop_last else -(-n_samples // size)


def assign_batches(ids: DataFrame, size: int, repeats: int = 1, drop_last: bool = False, seed: int | None = None) -> DataFrame:
    """Batches of one day each: rows of a day in code order (or in a seeded order), ``size`` at a time, repeated."""
    order = [F.xxhash64("code", "date", F.lit(seed)), F.col("code")] if seed is not None else [F.col("code")]
    d = ids.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats)))) if repeats > 1 else ids.withColumn("repeat", F.lit(1))
    d = d.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy("date", "repeat").orderBy(*order)) - 1) / size).cast("int"))
    if drop_last:
        d = d.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("date", "repeat", "batch"))).where(F.col("_n") == size).drop("_n")
    return d


def map_batches(df: DataFrame, fn, schema: str, keys: tuple[str, ...] = ("date", "batch"), per_call: int = 1) -> DataFrame:
    """A function on the pandas frame of each batch; the last of ``keys`` numbers batches within the others.

    A call costs about a millisecond whatever its rows, so a function that tells batches apart by their keys should get more at once:
    with ``per_call`` its frames hold so many whole batches (those that have rows), of one value of the other keys.
    """
    if per_call == 1:
        return df.groupBy(*keys).applyInPandas(fn, schema)
    call = F.floor(F.col(keys[-1]) / per_call)
    return df.withColumn("_call", call).groupBy(*keys[:-1], "_call").applyInPandas(lambda p: fn(p.drop(columns="_call")), schema)


def feature_view(df: DataFrame, begin: str, end: str, cols: list[str]) -> DataFrame:
    return df.where((F.col("date") >= F.to_date(F.lit(begin))) & (F.col("date") <= F.to_date(F.lit(end)))).select("code", "date", *[c for c in cols if c in df.columns])
