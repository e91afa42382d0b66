"""Queries: sources, sinks, streams and vector stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import vectors as vec
from ..sources import tables as t
from ..streaming import streams
from .harness import Inputs, query


def _scratch(v: Inputs, name: str) -> str:
    return v.scratch(name)


# bars land twice; the second time half of them with lower prices, which replace the first ones
@query("s01_read_daily_bars", "SELECT code, date, CASE WHEN code_idx % 2 = 0 THEN close - 1 ELSE close END AS close FROM bars WHERE date <= DATE '1996-12-31'")
def _(v: Inputs):
    path = _scratch(v, "daily")
    kinds = {c.split()[0]: c.split()[1] for c in t.DAILY.split(", ")}
    for bars in (v.bars, v.bars.where("code_idx % 2 = 0").withColumn("close", F.col("close") - 1)):
        bars.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()]).write.mode("append").parquet(path)
    return t.read_daily_bars(v.spark, path, ["close"], "1996-12-31").select("code", "date", "close")


@query("s02_read_m15_bars", "SELECT CAST(code AS VARCHAR) AS code, date, CAST(slot * 100 + 930 AS INT) AS time, CASE WHEN code % 3 = 0 THEN low ELSE high END AS close FROM m15")
def _(v: Inputs):
    path = _scratch(v, "m15")
    day = F.date_format("date", "yyyyMMdd")
    kinds = {c.split()[0]: c.split()[1] for c in t.M15.split(", ")}
    for time, close, rows in ((F.col("slot") * 100 + 930, "high", "true"), (F.concat(day, F.lpad((F.col("slot") * 100 + 930).cast("string"), 4, "0")), "low", "code % 3 = 0")):
        m = v.m15.where(rows).withColumns({"time": time, "close": F.col(close), "open": F.col("low"), "volume": F.col("n_ticks")})
        m.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()]).write.mode("append").option("header", True).csv(path)
    return t.read_m15_bars(v.spark, path, "csv").select("code", "date", "time", "close")


@query("s03_limit_board", "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS first_time, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, c_name) AS reason, 1 AS is_limit_up FROM customer")
def _(v: Inputs):
    c = v.customer
    raw = c.select(F.col("c_custkey").cast("string").alias("代码"), F.col("c_name").alias("涨停时间(时)"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("原因一"), F.col("c_name").alias("原因二"))
    return t.canonical_limit_board(raw, 1, {"代码": "code", "时间": "first_time"})


def _theme_json(v: Inputs):
    s = F.array(F.col("code").cast("string"), *[F.lit("x")] * 7, F.lit("12.5"), F.lit("首板"), F.when(F.col("code") % 3 == 0, F.lit("bad")).otherwise(F.col("boards").cast("string")), F.lit("ind"))
    stocks = v.theme_events.groupBy("date", "zscode", "zs_name").agg(F.collect_list(s).alias("StockList"))
    return stocks.groupBy("date").agg(F.collect_list(F.struct("zscode", "zs_name", "StockList")).alias("list"))


@query("s04_flatten_theme_board", "SELECT date, zscode, zs_name, CAST(code AS VARCHAR) AS code, 12.5::DOUBLE AS vol, CAST(CASE WHEN code % 3 = 0 THEN 0 ELSE boards END AS INT) AS boards, '' AS segment FROM theme_events")
def _(v: Inputs):
    return t.flatten_theme_board(_theme_json(v)).select("date", "zscode", "zs_name", "code", "vol", "boards", "segment")


@query("s05_flatten_trader_board", "SELECT date, lpad(CAST(code AS VARCHAR), 6, '0') AS code FROM seats WHERE code % 5 > 0 GROUP BY ALL")
def _(v: Inputs):
    s = F.struct(F.when(F.col("code") % 5 == 0, " ").otherwise(F.col("code").cast("string")).alias("code"), "amount")
    return t.flatten_trader_board(v.seats.groupBy("date").agg(F.collect_list(s).alias("stocks"))).select("date", "code")


@query("s06_read_news", "SELECT date_trunc('second', ts) AS ts, CASE WHEN event_type = 'view' THEN 'em' ELSE 'cls' END AS feed, CAST(CASE WHEN event_type = 'click' OR event_id % 3 < 2 THEN 1 ELSE 0 END AS INT) AS n FROM events WHERE (event_type = 'view' AND event_id % 3 < 2) OR event_type = 'click'")
def _(v: Inputs):
    six = F.lpad(F.col("user_id").cast("string"), 6, "0")
    em = v.events.where("event_type = 'view'").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("showTime"), F.array(F.concat((F.col("event_id") % 3).cast("string"), F.lit("."), six)).alias("stockList"))
    cls = v.events.where("event_type = 'click'").select(F.unix_timestamp(F.col("ts").cast("timestamp")).alias("ctime"), F.array(F.struct(F.concat(F.lit("sh"), six).alias("StockID"))).alias("stock_list"), F.array(F.lit("s")).alias("subjects"))
    return t.read_news(em, cls, "2000-01-01", "2100-01-01").select(F.col("ts").cast("timestamp_ntz").alias("ts"), "feed", F.size("codes").alias("n"))


@query("s07_slim_announcements", "SELECT id, code, trim(title) AS title FROM announcements")
def _(v: Inputs):
    a = v.announcements.withColumn("title", F.concat(F.lit(" <em>"), F.col("title"), F.lit("</em> ")))
    return t.slim_announcements(a, ["id", "code", "title"]).withColumn("title", F.trim("title"))


@query("s08_build_master", "SELECT lpad(CAST(c_custkey * 997 % 1000000 AS VARCHAR), 6, '0') || CASE WHEN c_custkey % 3 = 0 THEN '.BJ' ELSE '.SH' END AS ts_code, CASE c_custkey % 3 WHEN 1 THEN 'L' ELSE 'D' END AS list_status FROM customer WHERE c_custkey % 3 > 0 AND substr(lpad(CAST(c_custkey * 997 % 1000000 AS VARCHAR), 6, '0'), 1, 3) NOT IN ('900', '200')")
def _(v: Inputs):
    c = v.customer.select("c_custkey", F.concat(F.lpad((F.col("c_custkey") * 997 % 1000000).cast("string"), 6, "0"), F.when(F.col("c_custkey") % 3 == 0, ".BJ").otherwise(".SH")).alias("ts_code"))
    part = [c.where(f"c_custkey % 3 = {i}").select("ts_code") for i in (1, 2, 0)]
    return t.build_master(*part)


@query("s10_feature_table", "SELECT trade_date_idx, code_idx, CAST(volume AS FLOAT) AS volume, CAST(0.5 AS FLOAT) AS extra FROM bars")
def _(v: Inputs):
    path = _scratch(v, "features")
    t.write_feature_table(v.bars, path, ["volume", "extra"], 0.5)
    return t.read_feature_table(v.spark, path)


@query("s09_feature_meta", "SELECT count(*) AS rows, max(trade_date_idx) AS latest, 'volumes' AS name, 'bars' AS source, 'extra=0.5,volume=0.5' AS defaults FROM bars")
def _(v: Inputs):
    path = _scratch(v, "features")
    t.write_feature_table(v.bars, path, ["volume", "extra"], 0.5, "volumes", "bars")
    shown = F.array_join(F.array_sort(F.transform(F.map_entries("defaults"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))), ",")
    return t.read_feature_meta(v.spark, path).withColumn("defaults", shown).select("rows", "latest", "name", "source", "defaults")


@query("s11_base_features", "SELECT count(DISTINCT code) AS n_codes, max(date) AS latest_date, 2 AS n_columns, ['close float', 'volume float'] AS columns FROM bars")
def _(v: Inputs):
    return t.write_base_features(v.bars.select("date", "code", "close", "volume"), _scratch(v, "base"))


@query("m03_zero_time", "SELECT id FROM announcements WHERE second_of_day = 0 AND trim(title) <> '' AND code IN (SELECT code_idx FROM bars)")
def _(v: Inputs):
    a = v.announcements.select("id", "title", "code", F.timestamp_seconds("second_of_day").alias("ts"))
    return t.zero_time(a, v.bars.select(F.col("code_idx").cast("long").alias("code"))).select("id")


@query("m03_rejections", "SELECT count(*) FILTER (second_of_day <> 0) AS other_time, count(*) FILTER (second_of_day = 0 AND (title IS NULL OR trim(title) = '')) AS no_title, count(*) FILTER (second_of_day = 0 AND trim(title) <> '' AND code NOT IN (SELECT code_idx FROM bars)) AS unknown_code, count(*) FILTER (second_of_day = 0 AND trim(title) <> '' AND code IN (SELECT code_idx FROM bars)) AS kept FROM announcements")
def _(v: Inputs):
    a = v.announcements.select("id", "title", "code", F.timestamp_seconds("second_of_day").alias("ts"))
    return t.zero_time_rejections(a, v.bars.select(F.col("code_idx").cast("long").alias("code")))


@query("t11_pending_segments", """WITH e AS (SELECT p_brand AS segment, p_name AS reason, [p_type, concat('s', p_size)] AS names FROM part WHERE p_brand NOT LIKE 'Brand#1%'),
h AS (SELECT segment, min(reason) AS reason, row_number() OVER (PARTITION BY segment ORDER BY substr(reason, 1, 26)) AS i FROM e GROUP BY segment, substr(reason, 1, 26)), x AS (SELECT segment, unnest(names) AS name FROM e), m AS (SELECT segment, name, count(*) AS k FROM x GROUP BY ALL)
SELECT segment, count(*) AS n, (SELECT string_agg(reason, '|' ORDER BY reason) FROM h WHERE h.segment = e.segment AND i <= 2) AS reasons, (SELECT string_agg(concat(name, ':', CAST(k AS VARCHAR)), '|' ORDER BY k DESC, name) FROM m WHERE m.segment = e.segment) AS candidates FROM e GROUP BY segment""")
def _(v: Inputs):
    e = v.part.select(F.col("p_brand").alias("segment"), F.col("p_name").alias("reason"), F.array("p_type", F.concat(F.lit("s"), "p_size")).alias("names"))
    out = t.pending_segments(e, e.where("segment like 'Brand#1%'").select("segment").distinct())
    shown = F.transform("candidates", lambda c: F.concat_ws(":", c["name"], c["n"].cast("string")))
    return out.select("segment", "n", F.array_join("reasons", "|").alias("reasons"), F.array_join(shown, "|").alias("candidates"))


@query("t12_apply_mapping", "SELECT CAST(c_custkey AS VARCHAR) AS segment, CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE '' END ELSE 'old' END AS parent FROM customer")
def _(v: Inputs):
    c = v.customer.select(F.col("c_custkey").cast("string").alias("segment"), F.col("c_mktsegment").alias("parent"), "c_custkey")
    new = c.where("c_custkey % 2 = 0").select("segment", "parent", F.when(F.col("c_custkey") % 4 == 0, F.array("parent")).otherwise(F.array(F.lit("?"))).alias("candidates"))
    return t.apply_mapping(c.select("segment", F.lit("old").alias("parent")), new)


@query("m01_projection")
def _(v: Inputs):
    d = v.vectors.select("vec_id", "embedding")
    path = _scratch(v, "projection")
    vec.save_projection(vec.fit_projection(d, 16), path)
    return vec.apply_projection(d, vec.load_projection(path), "vec_id")


@query("m02_embed_new")
def _(v: Inputs):
    titles = v.announcements.select("id", F.col("title").alias("text"))
    path = _scratch(v, "titles")
    vec.append_new(v.spark, titles.where("id % 2 = 0"), path)
    return vec.append_new(v.spark, titles, path)


@query("i02_overlap_dedupe", "SELECT id FROM landing GROUP BY id")
def _(v: Inputs):
    path = _scratch(v, "landing")
    for batch in (1, 2):  # each lands in a folder of its own, as many files as Spark writes
        v.landing.where(f"batch = {batch}").select("id", F.col("ts").cast("timestamp").alias("ts"), "value").write.parquet(f"{path}/batch={batch}")
    stream = streams.read_batches(v.spark, f"{path}/batch=*", "id long, ts timestamp, value double", files=64)
    return streams.drain(streams.overlap_dedupe(stream), _scratch(v, "deduped")).select("id")
