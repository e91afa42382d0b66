"""Queries: column functions, over texts and numbers that the driver tables hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from .harness import Inputs, query

CODES = "SELECT DISTINCT code FROM bars"


@query("c01_norm_date", """WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y%m%d') WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') WHEN 2 THEN strftime(CAST(o_orderdate AS DATE), '%Y%m%d') || '.0' ELSE 'x' END AS s, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CASE WHEN s <> 'x' THEN d END AS date FROM t""")
def _(v: Inputs):
    d = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey") % 4
    s = F.when(k == 0, F.date_format(d, "yyyyMMdd")).when(k == 1, F.date_format(d, "yyyy-MM-dd")).when(k == 2, F.concat(F.date_format(d, "yyyyMMdd"), F.lit(".0"))).otherwise("x")
    return v.orders.select("o_orderkey", c.norm_date(s).alias("date"))


@query("c02_norm_code", "WITH t AS (SELECT DISTINCT code FROM bars WHERE code NOT LIKE 'bj%') SELECT code, CASE WHEN substr(code, 4, 1) = '6' THEN 'sh.' ELSE 'sz.' END || substr(code, 4) AS norm FROM t")
def _(v: Inputs):
    codes = v.bars.select("code").distinct().where("code not like 'bj%'")
    spelled = F.when(F.crc32("code") % 2 == 0, F.substring("code", 4, 6)).otherwise(F.concat(F.substring("code", 4, 6), F.lit("."), F.upper(F.substring("code", 1, 2))))
    return codes.select("code", c.norm_code(spelled).alias("norm"))


@query("c03_bare_code", "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS bare FROM customer")
def _(v: Inputs):
    return v.customer.select("c_custkey", c.bare_code(F.concat(F.lit("sz."), F.col("c_custkey").cast("string"))).alias("bare"))


@query("c10_price_limit", """WITH t AS (SELECT DISTINCT code, isST, trade_date_idx % 2 AS fresh FROM bars) SELECT code, isST, fresh, CASE WHEN substr(code, 4, 2) = '83' THEN CASE WHEN fresh = 1 THEN 0.0 ELSE 0.3 END WHEN fresh = 1 THEN 0.44 WHEN substr(code, 4, 2) IN ('30', '68') THEN 0.2 WHEN isST = 1 THEN 0.05 ELSE 0.1 END::DOUBLE AS price_limit FROM t""")
def _(v: Inputs):
    t = v.bars.select("code", "isST", (F.col("trade_date_idx") % 2).alias("fresh")).distinct()
    return t.select("*", c.price_limit(F.col("code"), F.col("isST"), F.col("fresh")).alias("price_limit"))


NAMED = "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN ' *ST' WHEN 1 THEN 'st' WHEN 2 THEN 'XDST' WHEN 3 THEN 'S*ST' ELSE '' END || c_name AS name FROM customer"


@query("c11_is_st_name", f"WITH t AS ({NAMED}) SELECT c_custkey, regexp_matches(upper(trim(name)), '^(XD|XR|DR|S)*[*]?ST') AS st FROM t")
def _(v: Inputs):
    return v.sql(NAMED).select("c_custkey", c.is_st_name(F.col("name")).alias("st"))


@query("c12_session_minute", """WITH t AS (SELECT event_id, CAST(extract(hour FROM ts) * 60 + extract(minute FROM ts) AS INT) - 570 AS m FROM events)
SELECT event_id, CAST(CASE WHEN m >= -15 AND m < 0 THEN 0 WHEN m BETWEEN 0 AND 120 THEN m WHEN m BETWEEN 210 AND 330 THEN m - 90 END AS INT) AS minute FROM t""")
def _(v: Inputs):
    return v.events.select("event_id", c.session_minute(F.date_format("ts", "yyyy-MM-dd H:mm:ss")).alias("minute"))


AMOUNTS = "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN concat('-', CAST(o_orderkey AS VARCHAR(20)), '.5亿') WHEN 1 THEN concat(CAST(o_orderkey AS VARCHAR(20)), '万') WHEN 2 THEN concat(CAST(o_orderkey AS VARCHAR(20)), '元') WHEN 3 THEN '--' ELSE concat('1,', CAST(100 + o_orderkey % 900 AS VARCHAR(20))) END AS s FROM orders"


@query("c13_cn_number", f"WITH t AS ({AMOUNTS}) SELECT o_orderkey, round(CASE o_orderkey % 5 WHEN 0 THEN -(o_orderkey + 0.5) * 1e8 WHEN 1 THEN o_orderkey * 1e4 WHEN 4 THEN 1100 + o_orderkey % 900 END, 2)::DOUBLE AS x FROM t")
def _(v: Inputs):
    return v.sql(AMOUNTS).select("o_orderkey", F.round(c.cn_number(F.col("s")), 2).alias("x"))


@query("c14_cn_wan", f"WITH t AS ({AMOUNTS}) SELECT o_orderkey, round(CASE o_orderkey % 5 WHEN 0 THEN -(o_orderkey + 0.5) * 1e4 WHEN 1 THEN o_orderkey WHEN 2 THEN o_orderkey / 1e4 WHEN 4 THEN 1100 + o_orderkey % 900 ELSE 0 END, 4)::DOUBLE AS x FROM t")
def _(v: Inputs):
    return v.sql(AMOUNTS).select("o_orderkey", F.round(c.cn_wan(F.col("s")), 4).alias("x"))


BOARDS = "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN '首板' WHEN 1 THEN concat(CAST(l_partkey % 9 AS VARCHAR(9)), '天', CAST(l_suppkey % 7 AS VARCHAR(9)), '板') WHEN 2 THEN '断板' END AS s, l_partkey, l_suppkey FROM lineitem"


@query("c15_days_boards", f"WITH t AS ({BOARDS}) SELECT l_orderkey, l_linenumber, CAST(CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 1 THEN l_partkey % 9 ELSE 0 END AS INT) AS days, CAST(CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 1 THEN l_suppkey % 7 ELSE 0 END AS INT) AS boards FROM t")
def _(v: Inputs):
    return v.sql(BOARDS).select("l_orderkey", "l_linenumber", c.days_boards(F.col("s")).alias("d")).select("l_orderkey", "l_linenumber", "d.days", "d.boards")


@query("c16_units", "SELECT code, date, round_even(volume * 100, 0) AS shares, round(round_even(amount * 1000, 4), 3) AS value FROM bars")
def _(v: Inputs):
    return v.bars.select("code", "date", c.lots_to_shares(F.col("volume")).alias("shares"), F.round(c.thousands_to_units(F.col("amount")), 3).alias("value"))


@query("c17_epoch_to_date", "SELECT event_id, CAST(ts + INTERVAL 8 HOUR AS DATE) AS local, CAST(ts + INTERVAL 8 HOUR AS DATE) + 1 AS next FROM events")
def _(v: Inputs):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return v.events.select("event_id", c.epoch_to_date(ms).alias("local"), c.epoch_to_date(ms, 1).alias("next"))


@query("c18_scalers", "SELECT event_id, round(ln(1 + value) / ln(201), 6) AS k200, round(ln(1 + value) / ln(41), 6) AS k40, round(least(value, 10) / 10, 6) AS capped, round(coalesce(CAST(value AS INT), 240) / 240.0, 6) AS first FROM events")
def _(v: Inputs):
    x = F.col("value")
    return v.events.select("event_id", F.round(c.log_scale(x, 200), 6).alias("k200"), F.round(c.log_scale(x, 40), 6).alias("k40"), F.round(c.cap_scale(x, 10.0), 6).alias("capped"), F.round(c.first_minute_scale(F.rint(x).cast("int")), 6).alias("first"))


@query("c19_decay", "SELECT event_id, round(exp(-value / 240), 6) AS weight FROM events")
def _(v: Inputs):
    return v.events.select("event_id", F.round(c.decay(F.col("value")), 6).alias("weight"))


@query("c20_clean_text", "SELECT p_partkey, trim(regexp_replace(concat('  ', p_name, ' ', chr(10), ' (', p_brand, ') '), '\\s+', ' ', 'g')) AS clean, lower(replace(trim(p_name), '　', '')) AS folded, trim(p_name) AS bare, p_brand AS inside FROM part")
def _(v: Inputs):
    s = F.concat(F.lit("  "), F.col("p_name"), F.lit(" \n ("), F.col("p_brand"), F.lit(") "))
    return v.part.select("p_partkey", c.clean_text(s).alias("clean"), c.fold_name(F.concat(F.lit(" \n　"), F.upper("p_name"), F.lit("　 "))).alias("folded"), c.strip_brackets(F.concat("p_name", F.lit("("), "p_brand", F.lit(")"))).alias("bare"), c.bracket_content(s).alias("inside"))


# types and brands, some in brackets, with finance words or with nothing specific
RELATED_NAMES = """SELECT DISTINCT CASE p_partkey % 5 WHEN 0 THEN concat(p_type, '（', p_brand, '）') WHEN 1 THEN concat(' ', upper(p_brand), '　') WHEN 2 THEN concat('年报', p_size) WHEN 3 THEN concat('概念', p_size) ELSE concat('(', p_size, ')', p_brand) END AS a FROM part"""
FOLDED = "lower(replace(trim({0}), '　', ''))"
BARE = "regexp_replace(lower(replace(trim({0}), '　', '')), '[（(].*?[)）]', '', 'g')"
FIN = "(" + " OR ".join("contains({0}, '" + w + "')" for w in c.FINANCE) + ")"
PIECES = "[substr({0}, i, 2) FOR i IN range(1, len({0}))]"


@query("c21_names_related", f"""WITH n AS ({RELATED_NAMES}), m AS (SELECT a, {FOLDED.format('a')} AS f, {BARE.format('a')} AS s FROM n),
p AS (SELECT x.a, y.a AS b, x.f AS fa, x.s AS sa, y.f AS fb, y.s AS sb FROM m x JOIN m y ON length(x.a) % 5 = length(y.a) % 5 AND substr(x.f, 1, 1) <> substr(y.f, 2, 1))
SELECT a, b, """ + " OR ".join(f"(length({x}) > 0 AND length({y}) > 0 AND (contains({x}, {y}) OR contains({y}, {x})))" for x in ("fa", "sa") for y in ("fb", "sb")) + f""" OR ({FIN.format('fa')} AND {FIN.format('fb')}) OR list_has_any([z FOR z IN {PIECES.format('fa')} IF z NOT IN ({', '.join(repr(w) for w in c.GENERIC)})], {PIECES.format('fb')}) AS related FROM p""")
def _(v: Inputs):
    n = v.sql(RELATED_NAMES).select("a", F.length("a") % 5, c.fold_name(F.col("a"))).toDF("a", "k", "f")
    pairs = n.join(n.select(F.col("a").alias("b"), "k", F.col("f").alias("g")), "k").where("substr(f, 1, 1) <> substr(g, 2, 1)")
    return pairs.select("a", "b", c.names_related(F.col("a"), F.col("b")).alias("related"))


@query("c23_rel_move", """SELECT code, date, round(pctChg / 100 / 0.1, 6) AS rel, CAST(CASE WHEN pctChg / 100 / 0.1 >= 0.7 THEN 1 ELSE 0 END AS INT) AS big_up, CAST(CASE WHEN pctChg / 100 / 0.1 <= -0.7 THEN 1 ELSE 0 END AS INT) AS big_down FROM bars""")
def _(v: Inputs):
    up, down = c.big_moves(F.col("pctChg"), F.lit(0.1))
    return v.bars.select("code", "date", F.round(c.rel_move(F.col("pctChg"), F.lit(0.1)), 6).alias("rel"), up.alias("big_up"), down.alias("big_down"))


@query("c26_null_to_zero", "SELECT code, date, round(coalesce(pctChg, 0), 6) AS x FROM bars")
def _(v: Inputs):
    return v.bars.select("code", "date", F.round(c.null_to_zero(F.col("pctChg")), 6).alias("x"))


@query("c27_feed_codes", """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN [lpad(CAST(p_partkey AS VARCHAR), 6, '0')] ELSE [] END::VARCHAR[] AS em, [lpad(CAST(p_partkey AS VARCHAR), 6, '0')] AS cls FROM part""")
def _(v: Inputs):
    six = F.lpad(F.col("p_partkey").cast("string"), 6, "0")
    feed = F.array(F.concat((F.col("p_partkey") % 3).cast("string"), F.lit("."), six), F.lit("bad"))
    feed = F.when(F.col("p_partkey") % 3 == 0, feed).otherwise(F.array(F.lit("2.123456"), F.lit("x")))
    return v.part.select("p_partkey", c.em_codes(feed).alias("em"), c.cls_codes(F.array(F.concat(F.lit("sh"), six), F.concat(F.lit("hk"), six))).alias("cls"))


@query("s02_m15_time", "SELECT event_id, CAST(strftime(ts, '%H%M') AS INT) AS time FROM events")
def _(v: Inputs):
    stamp = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyyMMddHHmmss")).otherwise(F.date_format("ts", "HHmm"))
    return v.events.select("event_id", c.m15_time(stamp).alias("time"))
