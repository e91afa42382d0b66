"""Theme events: group structure, episodes, leadership, carry; and the disclosed-trader board."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cap_scale, log_scale


def canonical_codes(df: DataFrame, prefix: str) -> DataFrame:
    """Per name the most frequent code with the prefix (the smallest on a tie); codes without it take their name's."""
    main = df.where(F.col("zscode").startswith(prefix)).groupBy("zs_name", "zscode").count()
    main = main.groupBy("zs_name").agg(F.min_by("zscode", F.struct(-F.col("count"), F.col("zscode"))).alias("_main"))
    return df.join(main, "zs_name", "left").withColumn("zscode", F.when(F.col("zscode").startswith(prefix), F.col("zscode")).otherwise(F.coalesce("_main", "zscode"))).drop("_main")


def group_stats(df: DataFrame) -> DataFrame:
    """Members of a theme on a day and the share of first boards among them."""
    w = Window.partitionBy("date", "zscode")
    return df.withColumns({"size": F.count(F.lit(1)).over(w), "first_share": F.avg((F.col("boards") == 1).cast("int")).over(w)})


def group_percentile(df: DataFrame, value: str, single: float = 0.0) -> DataFrame:
    w = Window.partitionBy("date", "zscode")
    rank = F.percent_rank().over(w.orderBy(value))
    return df.withColumn("rank_in_group", F.when(F.count(F.lit(1)).over(w) == 1, single).otherwise(rank))


def appearances(df: DataFrame) -> DataFrame:
    """One row per theme and event day, with the running number of the day among all event days.

    The numbering orders distinct days only, so it stays small whatever the number of events.
    """
    days = df.select("date").distinct().withColumn("di", F.row_number().over(Window.orderBy("date")) - 1)
    return df.select("zscode", "date").distinct().join(F.broadcast(days), "date")


def episodes(seen: DataFrame, index: str = "di", gap: int = 3) -> DataFrame:
    """Appearances at most ``gap`` apart are one episode; age counts within it from 0."""
    w = Window.partitionBy("zscode").orderBy(index)
    start = F.when(F.col(index) - F.lag(index).over(w) <= gap, 0).otherwise(1)
    df = seen.withColumn("_s", start).withColumn("episode", F.sum("_s").over(w))
    age = F.row_number().over(Window.partitionBy("zscode", "episode").orderBy(index)) - 1
    return df.withColumn("age", age).withColumn("is_fresh", (F.col("age") == 0).cast("int")).drop("_s")


def appearance_gap(seen: DataFrame, index: str = "di") -> DataFrame:
    """min(log1p(g) / log1p(60), 1) since the previous appearance; the first is 1."""
    g = F.col(index) - F.lag(index).over(Window.partitionBy("zscode").orderBy(index))
    return seen.withColumn("gap", F.coalesce(F.least(log_scale(g, 60), F.lit(1.0)), F.lit(1.0)))


def stock_gap(df: DataFrame) -> DataFrame:
    """st_lastgap: event days since a code's previous one in its entity, at most 60, over 60; the first is 1. ``df``: entity, code, di."""
    g = F.col("di") - F.lag("di").over(Window.partitionBy("entity", "code").orderBy("di"))
    return df.withColumn("st_lastgap", F.coalesce(F.least(g, F.lit(60)), F.lit(60)) / 60)


def new_face_ratio(df: DataFrame, seen: DataFrame, within: int = 5) -> DataFrame:
    """1 - overlap / size with the previous appearance's members if that is at most ``within`` event days ago, else 1."""
    sets = df.groupBy("zscode", "date").agg(F.collect_set("code").alias("members")).join(seen, ["zscode", "date"])
    w = Window.partitionBy("zscode").orderBy("di")
    near = F.col("di") - F.lag("di").over(w) <= within
    share = 1 - F.size(F.array_intersect("members", F.lag("members").over(w))) / F.size("members")
    return sets.withColumn("new_faces", F.when(near, share).otherwise(1.0)).drop("members")


def reappearance(df: DataFrame, seen: DataFrame, within: int = 5) -> DataFrame:
    """Times that a (theme, code) was there in the previous event days or earlier in the same day, capped at 5, over 5."""
    d = df.select("zscode", "code", "date").join(seen, ["zscode", "date"])
    w = Window.partitionBy("zscode", "code").orderBy("di")
    # rows of one day are alike but for how many of them came before
    same = F.row_number().over(w) - F.rank().over(w)
    return d.withColumn("back", cap_scale((F.count(F.lit(1)).over(w.rangeBetween(-within, -1)) + same).cast("double"), 5.0))


def theme_edges(df: DataFrame) -> DataFrame:
    return df.select("zscode", "code").distinct()


def event_base(members: DataFrame, themes: DataFrame, limits: DataFrame) -> DataFrame:
    """Members with boards from the theme board, else the limit board, else 1."""
    t = themes.groupBy("date", "code").agg(F.max("boards").alias("t_boards"))
    x = limits.groupBy("date", "code").agg(F.max("consecutive").alias("l_boards"), F.max("seal").alias("seal"), F.min("first_min").alias("first_min"), *([F.max("open_count").alias("open_count")] if "open_count" in limits.columns else []))
    return members.join(t, ["date", "code"], "left").join(x, ["date", "code"], "left").withColumn("boards", F.coalesce("t_boards", "l_boards", F.lit(1))).drop("t_boards", "l_boards")


def theme_strength(base: DataFrame) -> DataFrame:
    return base.groupBy("date", "entity").agg(F.max("boards").alias("max_boards"), F.avg("seal").alias("mean_seal"), F.avg("first_min").alias("mean_first"), F.count(F.lit(1)).alias("size"))


def scaled_theme(strength: DataFrame) -> DataFrame:
    """A theme's columns in the units of its feature family: boards over 10 and age over 20, both capped, seal as log over 10, first minute over 240 (none: 1)."""
    out = {"th_max_b": cap_scale(F.col("max_boards").cast("double"), 10.0), "th_seal": F.log1p(F.coalesce("mean_seal", F.lit(0.0))) / 10, "th_first": F.coalesce("mean_first", F.lit(240.0)) / 240}
    if "age" in strength.columns:
        out["th_age"] = cap_scale(F.col("age").cast("double"), 20.0)
    return strength.withColumns(out)


def promotion_rate(base: DataFrame, limits: DataFrame) -> DataFrame:
    """Members of day t that are up-limit on day t + 1, over the members of day t. ``base``: di, entity, code."""
    nxt = limits.where("is_limit_up = 1").select((F.col("di") - 1).alias("di"), "code").distinct().withColumn("_up", F.lit(1))
    return base.join(nxt, ["di", "code"], "left").groupBy("di", "entity").agg((F.coalesce(F.sum("_up"), F.lit(0)) / F.count(F.lit(1))).alias("promoted"))


def stock_strength(base: DataFrame) -> DataFrame:
    """Board scaling, distance to the leader and leader flag within (date, entity); scaled seal, first minute and openings (none: 0, 240, 0)."""
    w = Window.partitionBy("date", "entity")
    top = F.max("boards").over(w)
    opened = F.coalesce(F.col("open_count"), F.lit(0)) if "open_count" in base.columns else F.lit(0)
    return base.withColumns({"st_first": F.coalesce(F.col("first_min"), F.lit(240)) / 240, "st_open": opened / 10, "st_boards": cap_scale(F.col("boards").cast("double"), 10.0), "st_dist": cap_scale((top - F.col("boards")).cast("double"), 10.0), "st_leader": (F.col("boards") == top).cast("int"), "st_seal": F.log1p(F.coalesce("seal", F.lit(0.0))) / 10})


def history20(df: DataFrame) -> DataFrame:
    """Earlier rows of (entity, code) among the last 20, capped at 10, over 10."""
    w = Window.partitionBy("entity", "code").orderBy("di").rowsBetween(-20, -1)
    return df.withColumn("st_hist20", cap_scale(F.count(F.lit(1)).over(w).cast("double"), 10.0))


def carry_events(events: DataFrame, theme: DataFrame, days: int = 4, carry: str = "day") -> DataFrame:
    """Each (di, entity, code) event also stands on the next days, with ks_days = k / days and columns of its theme.

    Further columns of ``events`` are the stock's own: they hold on the event day and are 0 on the days after. The theme's columns
    are those of the day an event is carried to, with ``carry="event"`` those of its own day. On a conflict for (day, code) the nearest event wins.

    Of a code's events of one day that of the smallest entity wins, and until the code's next event day it is the nearest. So events meet
    once, by code, and are laid out over their days only after that; no day that another event wins is made.
    """
    own = [c for c in events.columns if c not in ("di", "entity", "code")]
    last = events.agg(F.max("di").alias("_last"))
    w = Window.partitionBy("code").orderBy("di", "entity")
    won = events.where("di is not null").withColumn("_first", F.coalesce(F.lag("di").over(w) != F.col("di"), F.lit(True))).where("_first").drop("_first")
    won = won.withColumn("_next", F.lead("di").over(Window.partitionBy("code").orderBy("di"))).crossJoin(F.broadcast(last))
    most = F.least(F.lit(days), F.col("_next") - F.col("di") - 1, F.col("_last") - F.col("di"))
    moved = won.select("entity", "code", F.col("di").alias("_di"), *own, F.explode(F.sequence(F.lit(0), most.cast("int"))).alias("k"))
    kept = [F.when(F.col("k") == 0, F.col(c)).otherwise(F.lit(0)).alias(c) for c in own]
    moved = moved.select((F.col("_di") + F.col("k")).alias("di"), "_di", "code", "entity", (F.col("k") / days).alias("ks_days"), *kept)
    at = theme.withColumnRenamed("di", "_at")
    day = F.col("_at") == F.col("_di" if carry == "event" else "di")
    return moved.join(at.withColumnRenamed("entity", "_e"), day & (F.col("entity") == F.col("_e")), "left").drop("_di", "_at", "_e").fillna(0)


def merge_family(features: DataFrame, new: DataFrame, own: list[str], keys: list[str]) -> DataFrame:
    """The family's own columns replaced by the new ones, other families kept, misses 0."""
    return features.drop(*own).join(new.select(*keys, *own), keys, "full").fillna(0)


def seat_profile(seats: str, amount: str, famous: list[int], marked: list[int]) -> dict[str, Column]:
    """Of an array of (seat, amount) structs: concentration and the shares of two kinds of seats; empty arrays give 0."""
    total = F.greatest(F.aggregate(seats, F.lit(0.0), lambda a, x: a + x[amount]), F.lit(1e-6))
    n = F.greatest(F.size(seats), F.lit(1))

    def share(kinds: list[int]) -> Column:
        return F.size(F.filter(seats, lambda x: x["seat"].isin(kinds))) / n

    return {"hhi": F.aggregate(seats, F.lit(0.0), lambda a, x: a + (x[amount] / total) * (x[amount] / total)), "famous": share(famous), "marked": share(marked)}


#: Words of a board reason that say turnover or amplitude.
TURNOVER_REASON, AMPLITUDE_REASON = "换手率", "振幅"


def trader_features(df: DataFrame, famous: list[int], marked: list[int]) -> DataFrame:
    """Per stock and day: clipped net share, both sides' concentration, marker share, famous bias, and whether the reason is turnover or amplitude.

    Columns buy, sell: arrays of (seat, amount); reason if there is one.
    """
    reason = F.coalesce(F.col("reason"), F.lit("")) if "reason" in df.columns else F.lit("")
    b, s = seat_profile("buy", "amount", famous, marked), seat_profile("sell", "amount", famous, marked)
    net = F.aggregate("buy", F.lit(0.0), lambda a, x: a + x["amount"]) - F.aggregate("sell", F.lit(0.0), lambda a, x: a + x["amount"])
    share = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), net / F.greatest("turnover", F.lit(1e-6))))
    return df.select("date", "code", share.alias("net_share"), b["hhi"].alias("buy_hhi"), s["hhi"].alias("sell_hhi"), b["marked"].alias("marked_share"), (b["famous"] - s["famous"]).alias("famous_bias"), reason.contains(TURNOVER_REASON).cast("int").alias("by_turnover"), reason.contains(AMPLITUDE_REASON).cast("int").alias("by_amplitude"))
