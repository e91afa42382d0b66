"""Sources and sinks: bars, boards, feeds, announcements, master snapshots and keyed feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import m15_time
from ..operators.bars import dedupe_by_key

DAILY = "date date, code string, open double, high double, low double, close double, preclose double, volume double, amount double, turn double, tradestatus int, pctChg double, isST int"
M15 = "date date, time string, code string, open double, high double, low double, close double, volume double, amount double"


def read_daily_bars(spark: SparkSession, path: str, cols: list[str] | None = None, end: str | None = None, file_format: str = "parquet") -> DataFrame:
    """The row that landed last per (code, date) with the fixed schema; the cut by date and the columns reach the scan."""
    df = _landed(spark.read.format(file_format).schema(DAILY).option("header", True).option("pathGlobFilter", "[!_]*").load(path), file_format)
    if end:
        df = df.where(F.col("date") <= F.to_date(F.lit(end)))
    if cols:
        df = df.select(*dict.fromkeys(["code", "date", *cols]), "_landed")
    return dedupe_by_key(df, ["code", "date"], [F.col("_landed")], "last").drop("_landed")


def _landed(df: DataFrame, file_format: str) -> DataFrame:
    """Rows with their place in the order of landing: file by time and path, then the place in the file.

    Formats without row numbers are counted on within each block of a file, which one task reads in order.
    """
    place = F.col("_metadata.row_index") if file_format == "parquet" else F.monotonically_increasing_id()
    block = F.lit(0).cast("long") if file_format == "parquet" else F.col("_metadata.file_block_start")
    return df.select("*", F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), block.alias("block"), place.alias("place")).alias("_landed"))


def read_m15_bars(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """The row that landed last per (code, date, time)."""
    df = _landed(spark.read.format(file_format).schema(M15).option("header", True).load(path), file_format).withColumn("time", m15_time(F.col("time")))
    return dedupe_by_key(df, ["code", "date", "time"], [F.col("_landed")], "last").drop("_landed")


def canonical_limit_board(df: DataFrame, side: int, field_map: dict[str, str], ignore: tuple[str, ...] = ()) -> DataFrame:
    """Headers to fields: bracketed units and the side's prefix go, words map by ``field_map``, anything that begins with 原因 is the reason.

    Unmapped headers, no code and (on the up side) no first time are errors before any job runs. Headers that map to
    one field give the first value that is not null.
    """
    import re

    found: dict[str, list[str]] = {}
    for c in df.columns:
        word = re.sub(r"[\[（(].*?[\]）)]", "", c).strip()
        word = re.sub(r"^(涨停|跌停)", "", word) or word
        field = "reason" if word.startswith("原因") else field_map.get(word)
        if field is None and word not in ignore:
            raise ValueError(f"unknown header {c!r}")
        if field:
            found.setdefault(field, []).append(c)
    for need in ("code", *(("first_time",) if side == 1 else ())):
        if need not in found:
            raise ValueError(f"no column for {need}")
    return df.select(*[F.coalesce(*[F.col(f"`{c}`") for c in cols]).alias(f) for f, cols in found.items()], F.lit(side).alias("is_limit_up"))


def flatten_theme_board(df: DataFrame) -> DataFrame:
    """(date, list of (zscode, zs_name, StockList of positional arrays)) to one row per theme and stock; short arrays give '' or null."""
    rows = df.select("date", F.explode("list").alias("t")).select("date", "t.zscode", "t.zs_name", F.explode("t.StockList").alias("s"))

    def text(i: int):
        return F.coalesce(F.get("s", F.lit(i)), F.lit(""))

    def number(i: int):
        return F.get("s", F.lit(i)).try_cast("double")

    return rows.select("date", "zscode", "zs_name", text(0).alias("code"), number(8).alias("vol"), text(9).alias("board_txt"), F.coalesce(F.get("s", F.lit(10)).try_cast("int"), F.lit(0)).alias("boards"), text(11).alias("industry"), number(12).alias("net"), number(13).alias("amount"), number(14).alias("turn"), number(15).alias("mktcap"), text(16).alias("segment"), F.substring(text(17), 1, 400).alias("reason"))


def flatten_trader_board(df: DataFrame) -> DataFrame:
    """(date, stocks) to one row per stock, codes padded to six digits; blank codes drop, the last of a (date, code) wins."""
    rows = df.select("date", F.posexplode("stocks").alias("pos", "s")).select("date", "pos", F.trim("s.code").alias("code"), "s").where("code <> ''")
    rows = rows.withColumn("code", F.lpad("code", 6, "0"))
    return dedupe_by_key(rows, ["date", "code"], [F.col("pos")], "last").drop("pos")


def read_news(first: DataFrame, second: DataFrame, start: str, end: str) -> DataFrame:
    """Two feeds as (ts, feed, codes, subjects); items without a time, or without codes and subjects, drop."""
    from ..functions.columns import cls_codes, em_codes

    a = first.select(F.try_to_timestamp("showTime", F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"), F.lit("em").alias("feed"), em_codes(F.col("stockList")).alias("codes"), F.array().cast("array<string>").alias("subjects"))
    b = second.select(F.timestamp_seconds(F.col("ctime").try_cast("long")).alias("ts"), F.lit("cls").alias("feed"), cls_codes(F.transform("stock_list", lambda s: s["StockID"])).alias("codes"), F.coalesce("subjects", F.array().cast("array<string>")).alias("subjects"))
    both = a.unionByName(b).where(F.col("ts").isNotNull() & (F.to_date("ts") >= F.to_date(F.lit(start))) & (F.to_date("ts") <= F.to_date(F.lit(end))))
    return both.where((F.size("codes") > 0) | (F.size("subjects") > 0))


def slim_announcements(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*keep).withColumn("title", F.trim(F.regexp_replace("title", "<[^>]+>", "")))


def build_master(listed: DataFrame, delisted: DataFrame, paused: DataFrame) -> DataFrame:
    """Three snapshots tagged L, D and P; only .SH and .SZ codes that do not begin with 900 or 200."""
    parts = [d.withColumn("list_status", F.lit(s)) for d, s in ((listed, "L"), (delisted, "D"), (paused, "P"))]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.where((F.col("ts_code").endswith(".SH") | F.col("ts_code").endswith(".SZ")) & ~F.substring("ts_code", 1, 3).isin("900", "200"))


def write_feature_table(df: DataFrame, path: str, contract: list[str], default: float, name: str = "", source: str = "") -> None:
    """Keyed table (trade_date_idx, code_idx) and one row of metadata (name, source, columns with defaults, rows, latest day): rows without a code drop, keys out of range are an error, missing columns take the default, values are floats."""
    n = F.col("code_idx")
    checked = df.where(n >= 0).withColumn("code_idx", F.when(n >= 100_000, F.raise_error(F.lit("code_idx out of range")).cast("int")).otherwise(n))
    cols = [(F.col(c) if c in df.columns else F.lit(default)).cast("float").alias(c) for c in contract]
    out = checked.select("trade_date_idx", "code_idx", *cols)
    out.repartitionByRange("trade_date_idx").sortWithinPartitions("trade_date_idx", "code_idx").write.mode("overwrite").parquet(f"{path}/data")
    meta = out.agg(F.count("*").alias("rows"), F.max("trade_date_idx").alias("latest")).withColumns({"name": F.lit(name), "source": F.lit(source), "defaults": F.create_map(*[x for c in contract for x in (F.lit(c), F.lit(float(default)))])})
    meta.write.mode("overwrite").parquet(f"{path}/meta")


def read_feature_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/data")


def read_feature_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/meta")


def write_base_features(df: DataFrame, path: str) -> DataFrame:
    """All numbers as floats, columns by name after the keys, partitioned by year and ordered by code and day; returns the build's metadata."""
    keys = ("date", "code")
    kinds = dict(df.dtypes)
    numbers = [c for c in sorted(df.columns) if c not in keys and kinds[c] not in ("string", "date", "timestamp")]
    out = df.select(*keys, *[F.col(c).cast("float").alias(c) for c in numbers], F.year("date").alias("year"))
    out.repartition("year", "code").sortWithinPartitions("code", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)
    schema = F.array(*[F.lit(f"{c} float") for c in numbers])
    return df.agg(F.countDistinct("code").alias("n_codes"), F.max("date").alias("latest_date"), F.lit(len(numbers)).alias("n_columns"), schema.alias("columns"))


def zero_time(df: DataFrame, master: DataFrame) -> DataFrame:
    """Announcements stamped exactly at midnight with a title and a known code. Columns ts, title, code."""
    at_zero = (F.hour("ts") == 0) & (F.minute("ts") == 0) & (F.second("ts") == 0)
    return df.where(at_zero & (F.trim("title") != "")).join(master.select("code").distinct(), "code", "left_semi")


def zero_time_rejections(df: DataFrame, master: DataFrame) -> DataFrame:
    """One row: how many announcements each condition of zero_time turns away, in its order, and how many stay."""
    at_zero = (F.hour("ts") == 0) & (F.minute("ts") == 0) & (F.second("ts") == 0)
    d = df.join(master.select("code", F.lit(True).alias("_known")).distinct(), "code", "left").withColumns({"_zero": F.coalesce(at_zero, F.lit(False)), "_titled": F.coalesce(F.trim("title") != "", F.lit(False))})
    known = F.coalesce("_known", F.lit(False))
    return d.agg(F.count_if(~F.col("_zero")).alias("other_time"), F.count_if(F.col("_zero") & ~F.col("_titled")).alias("no_title"), F.count_if(F.col("_zero") & F.col("_titled") & ~known).alias("unknown_code"), F.count_if(F.col("_zero") & F.col("_titled") & known).alias("kept"))


def pending_segments(events: DataFrame, mapped: DataFrame) -> DataFrame:
    """Unmapped segments, most events first, with at most two reasons whose first 26 characters differ.

    ``events``: segment, reason and, if the composite rows' candidate names are known, ``names``, which are counted too.
    """
    rest = events.join(mapped.select("segment"), "segment", "left_anti")
    head = rest.select("segment", "reason", F.substring("reason", 1, 26).alias("head")).groupBy("segment", "head").agg(F.min("reason").alias("reason"))
    two = head.withColumn("_r", F.row_number().over(Window.partitionBy("segment").orderBy("head"))).where("_r <= 2").groupBy("segment").agg(F.sort_array(F.collect_list("reason")).alias("reasons"))
    out = rest.groupBy("segment").agg(F.count("*").alias("n")).join(two, "segment")
    if "names" in events.columns:
        each = rest.select("segment", F.explode("names").alias("name")).groupBy("segment", "name").agg(F.count("*").alias("n_name"))
        ranked = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n_name")).alias("m"), "name", "n_name"))), lambda s: F.struct(s["name"].alias("name"), s["n_name"].alias("n")))
        out = out.join(each.groupBy("segment").agg(ranked.alias("candidates")), "segment", "left")
    return out.orderBy(F.desc("n"), "segment")


def apply_mapping(old: DataFrame, new: DataFrame) -> DataFrame:
    """Reviewed (segment, parent, candidates): a parent that is no candidate is blank; the new row of a segment replaces the old."""
    ok = new.select("segment", F.when(F.array_contains("candidates", F.col("parent")), F.col("parent")).otherwise("").alias("parent"))
    return ok.unionByName(old.select("segment", "parent").join(ok, "segment", "left_anti"))
