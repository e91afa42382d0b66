"""Cross-sections: breadth of the market and ranks within a day; and traits of a code's long history."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import big_moves, float_cap, price_limit, rel_move


def market_breadth(bars: DataFrame) -> DataFrame:
    return bars.groupBy("date").agg(
        F.avg("pctChg").alias("avg_pct"), F.sum("amount").alias("amount"), F.count_if(F.col("pctChg") > 0).alias("n_up"), F.count_if(F.col("pctChg") < 0).alias("n_down"), F.count_if(F.col("pctChg") == 0).alias("n_flat"), F.count("pctChg").alias("n")
    )


def limit_counts(breadth: DataFrame, limits: DataFrame) -> DataFrame:
    c = limits.groupBy("date").agg(F.count_if(F.col("is_limit_up") == 1).alias("n_limit_up"), F.count_if(F.col("is_limit_up") == -1).alias("n_limit_down"))
    return breadth.join(c, "date", "left").fillna(0, ["n_limit_up", "n_limit_down"])


def average_ranks(x: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Ranks from 1 within each group, ties sharing the mean of theirs; NaN is above all numbers and equals itself, as in Spark."""
    order = np.lexsort((x, group))
    s, g = x[order], group[order]
    starts, new = np.ones(len(x), bool), np.ones(len(x), bool)
    starts[1:] = g[1:] != g[:-1]
    new[1:] = starts[1:] | ((s[1:] != s[:-1]) & ~(np.isnan(s[1:]) & np.isnan(s[:-1])))
    first = np.flatnonzero(new)
    mean = (first + np.append(first[1:], len(x)) + 1) / 2
    out = np.empty(len(x))
    out[order] = mean[np.cumsum(new) - 1] - np.flatnonzero(starts)[np.cumsum(starts) - 1]
    return out


def _ranked_groups(table: pa.Table, cols: list[str], by: list[str], score) -> pa.Table:
    """Columns replaced by ``score(rank, number of values)`` within their groups; null stays null and takes no rank."""
    group = np.zeros(table.num_rows, np.int64)
    for c in by:
        held = table.column(c).combine_chunks().dictionary_encode()
        group = group * (len(held.dictionary) + 1) + np.asarray(held.indices.fill_null(len(held.dictionary)))
    group = np.unique(group, return_inverse=True)[1]
    for c in cols:
        held = table.column(c).combine_chunks().cast(pa.float64())
        there = np.asarray(held.is_valid())
        values, g = np.full(len(there), np.nan), group[there]
        values[there] = score(average_ranks(np.asarray(held.drop_null()), g), np.bincount(g)[g] if len(g) else g)
        table = table.set_column(table.schema.get_field_index(c), c, pa.array(values, mask=~there))
    return table


def ranked(df: DataFrame, cols: list[str], by: list[str], score=lambda rank, n: rank, buckets: int = 512) -> DataFrame:
    """Numeric columns as average ranks within the groups of ``by``, however many columns, by one shuffle.

    Groups, such as a day's codes, which a market bounds, are dealt into ``buckets``; an Arrow call ranks all columns of all groups of a bucket, which is
    all that a task holds at a time.
    """
    schema = ", ".join(f"`{f.name}` {'double' if f.name in cols else f.dataType.simpleString()}" for f in df.schema.fields)
    return df.groupBy(F.pmod(F.hash(*by), F.lit(buckets)).alias("_bucket")).applyInArrow(lambda t: _ranked_groups(t, cols, by, score), schema)


def rank01(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """(average rank - 1) / max(n - 1, 1) among non-nulls; null gives 0.5."""
    out = ranked(df, cols, by, lambda rank, n: (rank - 1) / np.maximum(n - 1, 1))
    return out.select(*[F.col(c) for c in df.columns if c not in cols], *[F.coalesce(c, F.lit(0.5)).alias(c) for c in cols])


def pct_cross_rank(df: DataFrame) -> DataFrame:
    """Average rank / n of the relative move among rows that are neither special-treatment nor new."""
    ok = df.where((F.col("isST") == 0) & (F.col("is_new") == 0) & (F.col("price_limit") > 0) & F.col("pctChg").isNotNull())
    ok = ok.select("date", "code", rel_move(F.col("pctChg"), F.col("price_limit")).alias("pct_rank"))
    return ranked(ok, ["pct_rank"], ["date"], lambda rank, n: rank / n)


def _lagged(n: int = 120) -> Window:
    return Window.partitionBy("code_idx").orderBy("trade_date_idx").rowsBetween(-n, -1)


def rolling_sums(df: DataFrame, cols: dict[str, Column], n: int = 120) -> DataFrame:
    """For each name the sum over a code's n rows before this one, and as n_name how many values that are; what is not finite counts as missing.

    A frame of n rows would add them up anew for every row. Here sums run through blocks of n rows: the frame is the rest of the block before, its
    total less the sum up to the place of this row, and the rows of this block so far. No sum spans more than a block, so none loses digits to a long history.
    """
    order = Window.partitionBy("code_idx").orderBy("trade_date_idx")
    at = F.row_number().over(order) - 1
    finite = {name: F.when(F.abs(c.cast("double")) < float("inf"), c.cast("double")) for name, c in cols.items()}
    d = df.withColumns({f"_x_{name}": c for name, c in finite.items()}).withColumn("_i", at).withColumns({"_block": F.floor(F.col("_i") / n), "_i": F.col("_i") % n})
    inside = Window.partitionBy("code_idx", "_block").orderBy("trade_date_idx")
    whole = Window.partitionBy("code_idx").orderBy("_block", "trade_date_idx")  # the order of the window above, so both take one sort
    run = [x for name in cols for x in (F.coalesce(F.sum(f"_x_{name}").over(inside), F.lit(0.0)).alias(name), F.count(f"_x_{name}").over(inside).cast("double").alias(f"n_{name}"))]
    d = d.withColumn("_run", F.struct(*run)).drop(*[f"_x_{name}" for name in cols])
    inner = F.col("_i") > 0
    d = d.withColumns({
        "_here": F.when(inner, F.lag("_run", 1).over(whole)), "_gone": F.when(inner, F.lag("_run", n + 1).over(whole)),
        "_total": F.last(F.when(F.col("_i") == n - 1, F.col("_run")), True).over(whole.rowsBetween(Window.unboundedPreceding, -1)),
    })
    names = [x for name in cols for x in (name, f"n_{name}")]
    zero = F.lit(0.0)
    return d.withColumns({x: F.coalesce(F.col(f"_here.{x}"), zero) + F.coalesce(F.col(f"_total.{x}"), zero) - F.coalesce(F.col(f"_gone.{x}"), zero) for x in names}).drop("_i", "_block", "_run", "_here", "_gone", "_total")


def raw_traits(bars: DataFrame, limits: DataFrame, breadth: DataFrame) -> DataFrame:
    """bars: trade_date_idx, code_idx, code, close, turn, amount, pctChg, isST; limits: trade_date_idx, code_idx,
    is_limit_up, open_count, first_minute; breadth: trade_date_idx, avg_pct."""
    limit = price_limit(F.col("code"), F.col("isST"), F.lit(0))
    up, down = big_moves(F.col("pctChg"), limit)
    # rates over the previous limit events of the code, known from the event day on
    ev = limits.where("is_limit_up = 1").withColumns({"zb": (F.col("open_count") > 0).cast("int"), "yz": ((F.col("first_minute") < 1) & (F.col("open_count") == 0)).cast("int")})
    rates = {f"{c}120": F.when(F.count(c).over(_lagged()) >= 20, F.avg(c).over(_lagged())) for c in ("zb", "yz")}
    ev = ev.withColumns(rates).select("trade_date_idx", "code_idx", "zb120", "yz120")
    d = bars.join(limits.select("trade_date_idx", "code_idx", "is_limit_up"), ["trade_date_idx", "code_idx"], "left").join(ev, ["trade_date_idx", "code_idx"], "left").join(breadth, "trade_date_idx", "left")
    d = d.withColumns({"lu": F.coalesce((F.col("is_limit_up") == 1).cast("int"), F.lit(0)), "ld": F.coalesce((F.col("is_limit_up") == -1).cast("int"), F.lit(0)), "fv": float_cap(F.col("amount"), F.col("turn"))})
    x, y = F.col("pctChg"), F.col("avg_pct")
    d = rolling_sums(d, {"lu120": F.col("lu"), "ld120": F.col("ld"), "bu120": F.coalesce(up, F.lit(0)), "bd120": F.coalesce(down, F.lit(0)), "turn120": F.col("turn"), "mx": x, "my": y, "mxy": x * y, "my2": y * y})
    now = Window.partitionBy("code_idx").orderBy("trade_date_idx")
    so_far, year = now.rowsBetween(Window.unboundedPreceding, 0), now.rowsBetween(-249, 0)
    d = d.withColumns({f"{c}120": F.when(F.col(f"n_{c}120") > 0, F.round(f"{c}120").cast("long")) for c in ("lu", "ld", "bu", "bd")})
    d = d.withColumns({c: F.when(F.col(f"n_{c}") >= 60, F.col(c) / F.col(f"n_{c}")) for c in ("turn120", "mx", "my", "mxy", "my2")})
    d = d.withColumns({
        "hi": F.when(F.count("close").over(year) >= 120, F.col("close") / F.max("close").over(year)),
        "lo": F.when(F.count("close").over(year) >= 120, F.col("close") / F.min("close").over(year)),
        "dsl": F.coalesce(F.least(F.col("trade_date_idx") - F.last(F.when(F.col("lu") == 1, F.col("trade_date_idx")), True).over(so_far), F.lit(250)), F.lit(250)),
        **{c: F.last(c, True).over(so_far) for c in ("zb120", "yz120")},
    })
    d = d.withColumns({
        "sru": F.when(F.col("bu120") >= 5, F.col("lu120") / F.col("bu120")),
        "srd": F.when(F.col("bd120") >= 5, F.col("ld120") / F.col("bd120")),
        "beta120": F.try_divide(F.col("mxy") - F.col("mx") * F.col("my"), F.col("my2") - F.col("my") * F.col("my")),
    })
    return d.select("trade_date_idx", "code_idx", "lu120", "ld120", "bu120", "bd120", "turn120", "hi", "lo", "dsl", "sru", "srd", "beta120", "zb120", "yz120", "fv")


def build_traits(bars: DataFrame, limits: DataFrame, breadth: DataFrame) -> DataFrame:
    """All traits as ranks within the day: one shuffle on days, and a call ranks all traits of some days."""
    d = raw_traits(bars, limits, breadth)
    return rank01(d, [c for c in d.columns if c not in ("trade_date_idx", "code_idx")], ["trade_date_idx"])
