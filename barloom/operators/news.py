"""News: session bucketing, mention counts, subject heat, novelty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import to_session
from ..functions.columns import decay, log_scale


def match_names(subjects: DataFrame, names: DataFrame, least: int = 2) -> DataFrame:
    """(subject, name) pairs where the name is contained.

    Distinct subjects and names meet where a name's first ``least`` characters stand in the subject, so this is a join on equal keys.
    """
    n = names.select("name").distinct().where(F.length("name") >= least).withColumn("_head", F.substring("name", 1, least))
    starts = F.sequence(F.lit(1), F.greatest(F.length("subject") - least + 1, F.lit(1)))
    heads = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("subject"), i, F.lit(least))))
    s = subjects.select("subject").distinct().select("subject", F.explode(heads).alias("_head"))
    return s.join(n, "_head").where(F.col("subject").contains(F.col("name"))).select("subject", "name")


def subject_heat(items: DataFrame, names: DataFrame) -> DataFrame:
    """Mentions of each name per day. ``items``: date, subject."""
    return items.join(match_names(items, names), "subject").groupBy("date", "name").agg(F.count("*").alias("heat"))


def attach_heat(members: DataFrame, heat: DataFrame) -> DataFrame:
    """Largest heat of the names of a code's entities per day. ``members``: date, code, name."""
    return members.join(heat, ["date", "name"]).groupBy("date", "code").agg(F.max("heat").alias("heat"))


def mention_counts(items: DataFrame, calendar: DataFrame, near: int = 60) -> DataFrame:
    """Per session and code: mentions by feed, mentions near the close, minutes of the latest. ``items``: ts, code, feed."""
    return to_session(items, calendar).groupBy("date", "tdi", "code").agg(*mentions(near))


def mentions(near: int = 60) -> list[Column]:
    """What is counted of a session's items."""
    return [F.count_if(F.col("feed") == "em").alias("n_em"), F.count_if(F.col("feed") == "cls").alias("n_cls"), F.count_if(F.col("minutes_to_close") <= near).alias("n_near"), F.min("minutes_to_close").alias("latest")]


def sum3(counts: DataFrame) -> DataFrame:
    w = Window.partitionBy("code").orderBy("tdi").rangeBetween(-2, 0)
    return counts.withColumn("n_3d", F.sum(F.col("n_em") + F.col("n_cls")).over(w))


def novelty(counts: DataFrame, gap: int = 5) -> DataFrame:
    before = F.lag("tdi").over(Window.partitionBy("code").orderBy("tdi"))
    return counts.withColumn("novel", F.when(before.isNull() | (F.col("tdi") - before > gap), 1).otherwise(0))


def news_features(items: DataFrame, calendar: DataFrame) -> DataFrame:
    return features_of_counts(mention_counts(items, calendar))


def features_of_counts(counts: DataFrame) -> DataFrame:
    """Scaled features of sessions' mention counts."""
    return scaled_features(novelty(sum3(counts)))


def scaled_features(d: DataFrame) -> DataFrame:
    """Counts with n_3d and novel, worked out by a batch or kept by the stream, in the units of the features."""
    return d.select("date", "code", log_scale(F.col("n_em"), 20).alias("nw_em"), log_scale(F.col("n_cls"), 20).alias("nw_cls"), log_scale(F.col("n_near"), 10).alias("nw_near"), decay(F.col("latest")).alias("nw_rec"), log_scale(F.col("n_3d"), 50).alias("nw_3d"), F.col("novel").alias("nw_nov"))
