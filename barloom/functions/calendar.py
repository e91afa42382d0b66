"""Calendar and security-master lookups. Both tables are small; the calendar has one row per trading day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import bare_code


def with_code_idx(df: DataFrame, master: DataFrame) -> DataFrame:
    """code_idx by master position; unknown or empty codes give -1. ``master``: code, code_idx."""
    m = master.select(F.col("code").alias("_m"), F.col("code_idx").alias("_i"))
    return df.join(m, F.col("code") == F.col("_m"), "left").withColumn("code_idx", F.coalesce("_i", F.lit(-1))).drop("_m", "_i")


def with_qualified_code(df: DataFrame, master: DataFrame) -> DataFrame:
    """The exchange-qualified form of a code by its six digits; codes that the master lacks stay as they are. ``master``: code."""
    m = master.select(bare_code(F.col("code")).alias("_bare"), F.col("code").alias("_code")).where("_bare <> ''").groupBy("_bare").agg(F.min("_code").alias("_code"))
    return df.withColumn("_b", bare_code(F.col("code"))).join(m, F.col("_b") == F.col("_bare"), "left").withColumn("code", F.coalesce("_code", "code")).drop("_b", "_bare", "_code")


def with_date_idx(df: DataFrame, calendar: DataFrame, text: str = "day") -> DataFrame:
    """tdi of a date text with or without dashes; -1 for a day without trading, -2 for what is no date."""
    digits = F.regexp_replace(text, "-", "")
    c = calendar.select(F.date_format("date", "yyyyMMdd").alias("_d"), F.col("tdi").alias("_t"))
    out = df.withColumn("_x", digits).join(F.broadcast(c), F.col("_x") == F.col("_d"), "left")
    return out.withColumn("tdi", F.when(~F.coalesce(F.col("_x").rlike(r"^\d+$"), F.lit(False)), -2).otherwise(F.coalesce("_t", F.lit(-1)))).drop("_x", "_d", "_t")


def idx_to_date(df: DataFrame, calendar: DataFrame) -> DataFrame:
    return df.join(F.broadcast(calendar.select("tdi", F.col("date").alias("day"))), "tdi", "left")


def _positions(calendar: DataFrame) -> DataFrame:
    """(day, pos): for each day of the year from the first trading day to the last how many trading days lie at or before it."""
    order = Window.orderBy("date")  # a row for each trading day
    c = calendar.select("date", F.row_number().over(order).alias("pos"), F.lead("date").over(order).alias("_next"))
    return c.select(F.explode(F.sequence("date", F.coalesce(F.date_sub("_next", 1), F.col("date")))).alias("day"), "pos")


def with_positions(df: DataFrame, calendar: DataFrame, **at: Column) -> DataFrame:
    """For each date in ``at`` a column with the number of trading days at or before it, by a join on equal days."""
    days = _positions(calendar)
    ends = calendar.agg(F.min("date").alias("lo"), F.max("date").alias("hi"), F.count("*").alias("n"))
    lo, hi, n = (ends.select(c).scalar() for c in ("lo", "hi", "n"))
    for name, date in at.items():
        d = days.select(F.col("day").alias("_day"), F.col("pos").alias("_pos"))
        df = df.withColumn("_at", date).join(F.broadcast(d), F.col("_at") == F.col("_day"), "left")
        df = df.withColumn(name, F.when(F.col("_at") < lo, 0).when(F.col("_at") >= hi, n).otherwise(F.col("_pos")).cast("long")).drop("_at", "_day", "_pos")
    return df


def days_between(df: DataFrame, calendar: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """The rows once for each trading day in [lo, hi], as ``date``: positions are laid out as a sequence, so the calendar is met on equal ones."""
    d = with_positions(df, calendar, _before=F.date_sub(lo, 1), _upto=hi).where("_upto > _before")
    d = d.withColumn("_pos", F.explode(F.sequence(F.col("_before") + 1, F.col("_upto")))).drop("_before", "_upto")
    ranks = calendar.select("date", F.row_number().over(Window.orderBy("date")).cast("long").alias("_rank"))
    return d.join(F.broadcast(ranks), F.col("_pos") == F.col("_rank")).drop("_pos", "_rank")


def bisect_idx(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """How many trading days lie at or before each row's date."""
    return with_positions(df, calendar, pos=F.col("date"))


def intervals(calendar: DataFrame, close: str = "15:00:00") -> DataFrame:
    """(prev_close, close] of each session: tdi, date, opens_after, closes_at."""
    at = F.to_timestamp(F.concat_ws(" ", F.col("date").cast("string"), F.lit(close)))
    return calendar.select("tdi", "date", at.alias("closes_at")).withColumn("opens_after", F.lag("closes_at").over(Window.orderBy("tdi")))


def target_date(calendar: DataFrame, now: str, bound: str) -> DataFrame:
    """Latest trading day at or before the bound; strictly before if the bound is today and it is before 15:00."""
    n, b = F.to_timestamp(F.lit(now)), F.to_date(F.lit(bound))
    early = (b == n.cast("date")) & (F.hour(n) < 15)
    return calendar.where(F.when(early, F.col("date") < b).otherwise(F.col("date") <= b)).agg(F.max("date").alias("target"))


def next_date(calendar: DataFrame, now: str, start: str) -> DataFrame:
    """First trading day after the start; the start itself if it is today and it is before 15:00."""
    n, s = F.to_timestamp(F.lit(now)), F.to_date(F.lit(start))
    today = (s == n.cast("date")) & (F.hour(n) < 15)
    return calendar.where(F.when(today, F.col("date") >= s).otherwise(F.col("date") > s)).agg(F.min("date").alias("next"))


def is_open(df: DataFrame, calendar: DataFrame) -> DataFrame:
    c = calendar.select(F.col("date").alias("_d"))
    return df.join(F.broadcast(c), F.col("date") == F.col("_d"), "left").withColumn("open_day", F.col("_d").isNotNull()).drop("_d")


def to_session(df: DataFrame, calendar: DataFrame, ts: str = "ts") -> DataFrame:
    """The session at whose close an item is known, and the minutes to it; later items than the last close drop.

    Each day of the year, trading or not, has one row with its next session and the one after; items look theirs up by day.
    """
    order, s = Window.orderBy("date"), F.struct("date", "tdi", "closes_at")  # one row per trading day
    days = intervals(calendar).withColumns({"_this": s, "_next": F.lead(s).over(order), "_from": F.date_add(F.lag("date").over(order), 1)})
    days = days.select(F.explode(F.sequence(F.coalesce("_from", "date"), F.col("date"))).alias("_day"), "_this", "_next")
    first = calendar.agg(F.min("date").alias("_first"))
    out = df.crossJoin(F.broadcast(first)).withColumn("_day", F.greatest(F.to_date(ts), "_first")).join(F.broadcast(days), "_day")
    hit = F.when(F.col("_this.closes_at") >= F.col(ts), F.col("_this")).otherwise(F.col("_next"))
    out = out.withColumn("_hit", hit).where("_hit is not null")
    return out.withColumns({"date": F.col("_hit.date"), "tdi": F.col("_hit.tdi"), "closes_at": F.col("_hit.closes_at"), "minutes_to_close": (F.col("_hit.closes_at").cast("double") - F.col(ts).cast("double")) / 60}).drop("_day", "_first", "_this", "_next", "_hit")


def prev_session(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """The last trading day strictly before each date; dates before the calendar drop."""
    d = with_positions(df, calendar, _before=F.date_sub("date", 1))
    c = calendar.select(F.col("date").alias("prev_date"), F.col("tdi").alias("prev_tdi"), F.row_number().over(Window.orderBy("date")).cast("long").alias("_rank"))
    return d.join(F.broadcast(c), F.col("_before") == F.col("_rank")).drop("_before", "_rank")
