"""Row selection: ranges with warm-up, tails, short series, subsamples, ranked search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bars import adjust_qfq, dedupe_by_key


def range_with_warmup(df: DataFrame, start: str | None, end: str | None, n: int) -> DataFrame:
    """Rows with date in [start, end] and the n rows before a code's first such row."""
    if start and end and start > end:
        raise ValueError("start is after end")
    inside = (F.col("date") >= F.to_date(F.lit(start))) if start else F.lit(True)
    if end:
        df = df.where(F.col("date") <= F.to_date(F.lit(end)))
    w = Window.partitionBy("code").orderBy("date")
    df = df.withColumn("_i", F.row_number().over(w))
    df = df.withColumn("_first", F.min(F.when(inside, F.col("_i"))).over(Window.partitionBy("code")))
    return df.where(F.col("_i") >= F.col("_first") - n).drop("_i", "_first")


def last_n(df: DataFrame, n: int, end: str | None = None) -> DataFrame:
    if end:
        df = df.where(F.col("date") <= F.to_date(F.lit(end)))
    return df.withColumn("_r", F.row_number().over(Window.partitionBy("code").orderBy(F.desc("date")))).where(F.col("_r") <= n).drop("_r")


def first_last(df: DataFrame, value: str = "close") -> DataFrame:
    return df.groupBy("code").agg(F.min("date").alias("first_date"), F.min_by(value, "date").alias("first_value"), F.max("date").alias("last_date"), F.max_by(value, "date").alias("last_value"))


def recent_adjusted_closes(df: DataFrame, n: int = 130) -> DataFrame:
    """The last n adjusted closes of each code.

    A row's factor depends on later ratios only, and a ratio on the traded close before it. So rows are cut first, to those from the code's
    (n + 1)-th last traded one on (all, if there are fewer), and only these are adjusted. The cut rows of a store, ``Store.tail(n + 1)`` of traded rows, give the same.
    """
    later = F.count_if(F.col("tradestatus") == 1).over(Window.partitionBy("code").orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, -1))
    cut = df.select("code", "date", "open", "high", "low", "close", "preclose", "tradestatus", later.alias("_later")).where(F.col("_later") <= n).drop("_later")
    return last_n(adjust_qfq(cut), n).select("code", "date", "close")


def security_view(bars: DataFrame, limits: DataFrame, code: str, n: int, end: str | None = None) -> DataFrame:
    """The last n rows of one code with 0/1 flags of limit moves; the filter reaches the scan of both sides."""
    own = last_n(bars.where(F.col("code") == code), n, end)
    flags = limits.where(F.col("code") == code).groupBy("code", "date").agg(F.max(F.when(F.col("is_limit_up") > 0.5, 1).otherwise(0)).alias("limit_up"), F.max(F.when(F.col("is_limit_up") < -0.5, 1).otherwise(0)).alias("limit_down"))
    return own.join(flags, ["code", "date"], "left").fillna(0, ["limit_up", "limit_down"])


def long_enough(df: DataFrame, n: int, codes: list[str] | None = None, max_codes: int | None = None) -> DataFrame:
    """Codes with more than n rows, optionally only given ones or the first few by code."""
    if codes is not None:
        df = df.where(F.col("code").isin(codes))
    kept = df.groupBy("code").count().where(F.col("count") > n).select("code")
    if max_codes is not None:
        kept = kept.orderBy("code").limit(max_codes)
    return df.join(kept, "code", "left_semi")


def valid_keys(df: DataFrame, last_tdi: int) -> DataFrame:
    return df.where((F.col("code_idx") >= 0) & (F.col("code_idx") < 99999) & (F.col("trade_date_idx") >= 0) & (F.col("trade_date_idx") <= last_tdi))


def subsample(df: DataFrame, ratio: float, seed: int) -> DataFrame:
    """max(1, int(n * ratio)) rows of each code, in an order that is a function of code, index and seed."""
    w = Window.partitionBy("code")
    order = F.row_number().over(w.orderBy(F.xxhash64("code", "trade_date_idx", F.lit(seed)), "trade_date_idx"))
    keep = F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(w) * ratio))
    return df.withColumn("_r", order).withColumn("_k", keep).where("_r <= _k").drop("_r", "_k")


def search_master(master: DataFrame, query: str, limit: int) -> DataFrame:
    """Ranked matches: exact, then prefixes of code, initials, alias and name, then places inside; ties by length and code.

    ``master``: code, name, initials, alias. An empty query gives the first codes.
    """
    if not query.strip():
        return master.orderBy("code").limit(limit).select("code", "name", F.lit(0).alias("tier"))
    q = query.strip().lower()
    code, name, initials, alias = (F.lower(F.coalesce(c, F.lit(""))) for c in ("code", "name", "initials", "alias"))
    tier = (
        F.when((code == q) | (name == q), 0).when(code.startswith(q), 1).when(initials.startswith(q), 2).when(alias.startswith(q), 3).when(name.startswith(q), 4)
        .when(code.contains(q), 5).when(initials.contains(q), 6).when(alias.contains(q), 7).when(name.contains(q), 8)
    )
    place = F.when(tier == 5, F.instr(code, q)).when(tier == 6, F.instr(initials, q)).when(tier == 7, F.instr(alias, q)).when(tier == 8, F.instr(name, q)).otherwise(0)
    hits = master.withColumn("tier", tier).where("tier is not null").withColumn("_p", place)
    return hits.orderBy("tier", "_p", F.length("name"), "code").limit(limit).select("code", "name", "tier")


def scope_members(members: DataFrame) -> DataFrame:
    """Primary members with an entity, one row per day and code: the smallest entity's. ``members``: date, code, entity_id, is_primary."""
    return dedupe_by_key(members.where("is_primary and entity_id > 0"), ["date", "code"], [F.col("entity_id")], "first")


def scope_theme_events(df: DataFrame, since: str = "2019-01-01") -> DataFrame:
    return df.where((F.col("date") >= F.to_date(F.lit(since))) & (F.col("zscode") != "0"))
