"""Queries: indicators per code, cross-sections and traits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import price_limit
from ..operators import cross, indicators
from .harness import Inputs, query


def r6(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


def times6(*names: str):
    """Rounded in doubles as the statement does it: the value times a million, half away from zero. F.round goes by the shortest decimal
    that names the double, so means of prices that end in half a millionth may come out one off."""

    def one(c: str):
        y = F.abs(F.col(c) * 1e6)
        whole = F.floor(y).cast("double")
        return (F.signum(c) * (whole + (y - whole >= 0.5).cast("double")) / 1e6).alias(c)

    return [one(n) for n in names]


def sql6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


W = "OVER (PARTITION BY code ORDER BY date ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"


def _full(agg: str, n: int, name: str) -> str:
    w = W.format(n - 1)
    return f"CASE WHEN count(*) {w} = {n} THEN {agg} {w} END AS {name}"


@query("w01_sma", f"WITH x AS (SELECT code, date, {', '.join(_full('avg(close)', n, f'ma{n}') for n in (5, 10, 20, 30, 60))} FROM bars) SELECT code, date, {sql6('ma5', 'ma10', 'ma20', 'ma30', 'ma60')} FROM x")
def _(v: Inputs):
    return indicators.sma(v.bars.select("code", "date", "close")).select("code", "date", *times6("ma5", "ma10", "ma20", "ma30", "ma60"))


@query("w04_bollinger", f"WITH x AS (SELECT code, date, {_full('avg(close)', 20, 'm')}, {_full('stddev_pop(close)', 20, 's')} FROM bars) SELECT code, date, round(m + 2 * s, 5) AS boll_up, round(m, 5) AS boll_mid, round(m - 2 * s, 5) AS boll_low FROM x")
def _(v: Inputs):
    d = indicators.bollinger(v.bars.select("code", "date", "close"))
    return d.select("code", "date", *[F.round(c, 5).alias(c) for c in ("boll_up", "boll_mid", "boll_low")])


IS_NEW = """x AS (SELECT *, CASE WHEN trade_date_idx - lag(trade_date_idx) OVER (PARTITION BY code ORDER BY trade_date_idx) > 30 THEN 1 ELSE 0 END AS jump,
  row_number() OVER (PARTITION BY code ORDER BY trade_date_idx) AS nth FROM bars),
flagged AS (SELECT *, CASE WHEN nth = 1 OR max(jump) OVER (PARTITION BY code ORDER BY trade_date_idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) = 1 THEN 1 ELSE 0 END AS is_new FROM x)"""
LIMIT = """CASE WHEN substr(code, 4, 2) IN ('43', '83', '87', '88') THEN CASE WHEN {new} = 1 THEN 0.0 ELSE 0.3 END
  WHEN substr(code, 4, 2) IN ('00', '60', '30', '68') THEN CASE WHEN {new} = 1 THEN 0.44 WHEN substr(code, 4, 2) IN ('30', '68') THEN 0.2 WHEN {st} = 1 THEN 0.05 ELSE 0.1 END
  ELSE -1.0 END"""


@query("w06_is_new", f"WITH {IS_NEW} SELECT code, date, CAST(is_new AS INT) AS is_new FROM flagged")
def _(v: Inputs):
    return indicators.is_new(v.bars).select("code", "date", "is_new")


NUMBERED = "n AS (SELECT code, date, high, low, close, row_number() OVER (PARTITION BY code ORDER BY date) AS i FROM bars)"
MACD = f"""WITH RECURSIVE {NUMBERED},
e AS (SELECT code, i, close AS f, close AS s FROM n WHERE i = 1
  UNION ALL SELECT n.code, n.i, 2.0 / 13 * n.close + (1 - 2.0 / 13) * e.f, 2.0 / 27 * n.close + (1 - 2.0 / 27) * e.s FROM e JOIN n ON n.code = e.code AND n.i = e.i + 1),
g AS (SELECT code, i, f - s AS sig FROM e WHERE i = 1
  UNION ALL SELECT e.code, e.i, 2.0 / 10 * (e.f - e.s) + (1 - 2.0 / 10) * g.sig FROM g JOIN e ON e.code = g.code AND e.i = g.i + 1)
SELECT n.code, n.date, round(f - s, 5) AS macd, round(sig, 5) AS macd_signal, round(f - s - sig, 5) AS macd_hist FROM n JOIN e ON n.code = e.code AND n.i = e.i JOIN g ON n.code = g.code AND n.i = g.i"""


@query("w02_macd", MACD)
def _(v: Inputs):
    d = indicators.macd(v.bars.select("code", "date", "close"))
    return d.select("code", "date", *[F.round(c, 5).alias(c) for c in ("macd", "macd_signal", "macd_hist")])


RSI = f"""WITH RECURSIVE {NUMBERED},
d AS (SELECT *, greatest(close - lag(close) OVER (PARTITION BY code ORDER BY i), 0) AS up, greatest(lag(close) OVER (PARTITION BY code ORDER BY i) - close, 0) AS down FROM n),
a AS (SELECT code, CAST(15 AS BIGINT) AS i, avg(up) AS u, avg(down) AS w FROM d WHERE i BETWEEN 2 AND 15 GROUP BY code HAVING count(*) = 14
  UNION ALL SELECT d.code, d.i, (a.u * 13 + d.up) / 14, (a.w * 13 + d.down) / 14 FROM a JOIN d ON d.code = a.code AND d.i = a.i + 1)
SELECT n.code, n.date, round(100 - 100 / (1 + u / CASE WHEN w = 0 THEN 1e-10 ELSE w END), 5) AS rsi FROM n LEFT JOIN a ON n.code = a.code AND n.i = a.i"""


@query("w03_rsi", RSI)
def _(v: Inputs):
    return indicators.rsi(v.bars.select("code", "date", "close")).select("code", "date", F.round(F.nanvl("rsi", F.lit(None)), 5).alias("rsi"))


KDJ = f"""WITH RECURSIVE {NUMBERED},
p AS (SELECT *, max(high) OVER w AS hh, min(low) OVER w AS ll FROM n WINDOW w AS (PARTITION BY code ORDER BY i ROWS BETWEEN 8 PRECEDING AND CURRENT ROW)),
q AS (SELECT *, CASE WHEN hh = ll THEN 50 ELSE (close - ll) / (hh - ll) * 100 END AS rsv FROM p),
k AS (SELECT code, i, 50.0::DOUBLE AS k, 50.0::DOUBLE AS d FROM q WHERE i = 9
  UNION ALL SELECT q.code, q.i, 2.0 / 3 * k.k + q.rsv / 3, 2.0 / 3 * k.d + (2.0 / 3 * k.k + q.rsv / 3) / 3 FROM k JOIN q ON q.code = k.code AND q.i = k.i + 1)
SELECT n.code, n.date, round(k, 5) AS k, round(d, 5) AS d, round(3 * k - 2 * d, 5) AS j FROM n LEFT JOIN k ON n.code = k.code AND n.i = k.i"""


@query("w05_kdj", KDJ)
def _(v: Inputs):
    d = indicators.kdj(v.bars.select("code", "date", "high", "low", "close"))
    return d.select("code", "date", *[F.round(F.nanvl(c, F.lit(None)), 5).alias(c) for c in ("k", "d", "j")])


def _features(*names: str) -> list:
    return [F.round(F.nanvl(c, F.lit(None)), 5).alias(c) for c in names]


@query("w34_daily_features", f"""SELECT r.code, r.date, CAST(f.is_new AS INT) AS is_new, CAST(f.price_limit AS DOUBLE) AS price_limit, round(ma5, 6) AS ma5, round(ma60, 6) AS ma60, round(m + 2 * s, 5) AS boll_up, macd, rsi, k, d, j
FROM (SELECT code, date, {_full('avg(close)', 5, 'ma5')}, {_full('avg(close)', 60, 'ma60')}, {_full('avg(close)', 20, 'm')}, {_full('stddev_pop(close)', 20, 's')} FROM bars) r
JOIN (WITH {IS_NEW} SELECT code, date, is_new, {LIMIT.format(new='is_new', st='isST')} AS price_limit FROM flagged) f ON r.code = f.code AND r.date = f.date
JOIN ({MACD}) mc ON r.code = mc.code AND r.date = mc.date JOIN ({RSI}) rs ON r.code = rs.code AND r.date = rs.date JOIN ({KDJ}) kd ON r.code = kd.code AND r.date = kd.date""")
def _(v: Inputs):
    d = indicators.daily_features(v.bars)
    return d.select("code", "date", "is_new", *r6("price_limit", "ma5", "ma60"), *_features("boll_up", "macd", "rsi", "k", "d", "j"))


def _of_m15(sql: str) -> str:
    """The statement over 15-minute bars, whose order is day and slot."""
    numbered = "n AS (SELECT code, date, slot, high, low, amount / n_ticks AS close, row_number() OVER (PARTITION BY code ORDER BY date, slot) AS i FROM m15)"
    return sql.replace(NUMBERED, numbered).replace("SELECT n.code, n.date,", "SELECT n.code, n.date, n.slot,")


@query("w35_m15_features", f"SELECT r.code, r.date, r.slot, rsi, k, d, j FROM ({_of_m15(RSI)}) r JOIN ({_of_m15(KDJ)}) kd ON r.code = kd.code AND r.date = kd.date AND r.slot = kd.slot")
def _(v: Inputs):
    d = indicators.m15_features(v.m15.withColumn("close", F.col("amount") / F.col("n_ticks")))
    return d.select("code", "date", "slot", *_features("rsi", "k", "d", "j"))


SLOTS = list(range(16))
PIVOT = "SELECT code, date, " + ", ".join(f"round(max(CASE WHEN slot = {s} THEN amount END), 6) AS m15_{s}_amount" for s in SLOTS) + " FROM m15 GROUP BY code, date"


@query("p01_pivot_m15", PIVOT)
def _(v: Inputs):
    d = indicators.pivot_m15(v.m15, SLOTS, ["amount"])
    return d.select("code", "date", *r6(*[f"m15_{s}_amount" for s in SLOTS]))


BREADTH = "SELECT date, avg(pctChg) AS avg_pct, sum(amount) AS amount, count(*) FILTER (pctChg > 0) AS n_up, count(*) FILTER (pctChg < 0) AS n_down, count(*) FILTER (pctChg = 0) AS n_flat, count(pctChg) AS n FROM bars GROUP BY date"


@query("a01_market_breadth", f"WITH b AS ({BREADTH}) SELECT date, round(avg_pct, 6) AS avg_pct, round(amount, 2) AS amount, n_up, n_down, n_flat, n FROM b")
def _(v: Inputs):
    return cross.market_breadth(v.bars).select("date", *r6("avg_pct"), F.round("amount", 2).alias("amount"), "n_up", "n_down", "n_flat", "n")


@query("a02_limit_counts", """WITH b AS (SELECT date, count(*) AS n FROM m15 GROUP BY date), l AS (SELECT date, count(*) FILTER (is_limit_up = 1) AS u, count(*) FILTER (is_limit_up = -1) AS d FROM limit_events GROUP BY date)
SELECT b.date, n, coalesce(u, 0) AS n_limit_up, coalesce(d, 0) AS n_limit_down FROM b LEFT JOIN l ON b.date = l.date""")
def _(v: Inputs):
    return cross.limit_counts(v.m15.groupBy("date").agg(F.count("*").alias("n")), v.limit_events)


AVG_RANK = "rank() OVER (PARTITION BY {by}, {c} IS NULL ORDER BY {c}) + (count(*) OVER (PARTITION BY {by}, {c} IS NULL, {c}) - 1) / 2.0"


@query("w16_rank01", f"SELECT date, code, CASE WHEN pctChg IS NULL THEN 0.5 ELSE round(({AVG_RANK.format(by='date', c='pctChg')} - 1) / greatest(count(pctChg) OVER (PARTITION BY date) - 1, 1), 6) END AS pctChg, CASE WHEN turn IS NULL THEN 0.5 ELSE round(({AVG_RANK.format(by='date', c='turn')} - 1) / greatest(count(turn) OVER (PARTITION BY date) - 1, 1), 6) END AS turn FROM bars")
def _(v: Inputs):
    return cross.rank01(v.bars.select("date", "code", "pctChg", "turn"), ["pctChg", "turn"], ["date"]).select("date", "code", *r6("pctChg", "turn"))


@query("w17_pct_cross_rank", f"""WITH {IS_NEW}, l AS (SELECT *, {LIMIT.format(new='is_new', st='isST')} AS price_limit FROM flagged),
o AS (SELECT *, pctChg / 100 / price_limit AS rel FROM l WHERE isST = 0 AND is_new = 0 AND price_limit > 0 AND pctChg IS NOT NULL)
SELECT date, code, round(({AVG_RANK.format(by='date', c='rel')}) / count(*) OVER (PARTITION BY date), 6) AS pct_rank FROM o""")
def _(v: Inputs):
    d = indicators.is_new(v.bars)
    d = d.withColumn("price_limit", price_limit(F.col("code"), F.col("isST"), F.col("is_new")))
    return cross.pct_cross_rank(d).select("date", "code", *r6("pct_rank"))


def _trait_inputs(v: Inputs):
    bars = v.keep(v.bars.select("date", "trade_date_idx", "code_idx", "code", "close", "turn", "amount", "pctChg", "isST", "tradestatus", "volume"), "bars")  # read three times
    up = F.col("pctChg") >= 30
    limits = bars.where(up | (F.col("pctChg") <= -30)).select("trade_date_idx", "code_idx", F.when(up, 1).otherwise(-1).alias("is_limit_up"), (F.col("trade_date_idx") % 3).alias("open_count"), (F.col("trade_date_idx") % 4).alias("first_minute"))
    return bars, limits, cross.market_breadth(bars).join(bars.select("date", "trade_date_idx").distinct(), "date").select("trade_date_idx", "avg_pct")


L = "OVER (PARTITION BY code_idx ORDER BY trade_date_idx ROWS BETWEEN 120 PRECEDING AND 1 PRECEDING)"
Y = "OVER (PARTITION BY code_idx ORDER BY trade_date_idx ROWS BETWEEN 249 PRECEDING AND CURRENT ROW)"
S = "OVER (PARTITION BY code_idx ORDER BY trade_date_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
TRAITS = f"""WITH lim AS (SELECT trade_date_idx, code_idx, CASE WHEN pctChg >= 30 THEN 1 ELSE -1 END AS is_limit_up, trade_date_idx % 3 AS open_count, trade_date_idx % 4 AS first_minute FROM bars WHERE pctChg >= 30 OR pctChg <= -30),
mk AS (SELECT trade_date_idx, avg(pctChg) AS avg_pct FROM bars GROUP BY trade_date_idx),
ev AS (SELECT trade_date_idx, code_idx, CASE WHEN count(*) {L} >= 20 THEN avg(CASE WHEN open_count > 0 THEN 1 ELSE 0 END) {L} END AS zb, CASE WHEN count(*) {L} >= 20 THEN avg(CASE WHEN first_minute < 1 AND open_count = 0 THEN 1 ELSE 0 END) {L} END AS yz FROM lim WHERE is_limit_up = 1),
d AS (SELECT b.*, avg_pct, zb, yz, CASE WHEN is_limit_up = 1 THEN 1 ELSE 0 END AS lu, CASE WHEN is_limit_up = -1 THEN 1 ELSE 0 END AS ld, {LIMIT.format(new='0', st='isST')} AS price_limit,
  CASE WHEN turn > 0.05 AND amount > 0 THEN 100 * amount / turn END AS fv
  FROM bars b LEFT JOIN lim USING (trade_date_idx, code_idx) LEFT JOIN mk USING (trade_date_idx) LEFT JOIN ev USING (trade_date_idx, code_idx)),
e AS (SELECT *, CASE WHEN price_limit >= 0.04 AND pctChg / 100 / price_limit >= 0.7 THEN 1 ELSE 0 END AS bu, CASE WHEN price_limit >= 0.04 AND pctChg / 100 / price_limit <= -0.7 THEN 1 ELSE 0 END AS bd FROM d),
f AS (SELECT trade_date_idx, code_idx, close, fv, sum(lu) {L} AS lu120, sum(ld) {L} AS ld120, sum(bu) {L} AS bu120, sum(bd) {L} AS bd120,
  CASE WHEN count(turn) {L} >= 60 THEN avg(turn) {L} END AS turn120,
  CASE WHEN count(close) {Y} >= 120 THEN close / max(close) {Y} END AS hi, CASE WHEN count(close) {Y} >= 120 THEN close / min(close) {Y} END AS lo,
  coalesce(least(trade_date_idx - max(CASE WHEN lu = 1 THEN trade_date_idx END) {S}, 250), 250) AS dsl,
  CASE WHEN count(pctChg) {L} >= 60 THEN avg(pctChg) {L} END AS mx, CASE WHEN count(avg_pct) {L} >= 60 THEN avg(avg_pct) {L} END AS my,
  CASE WHEN count(pctChg * avg_pct) {L} >= 60 THEN avg(pctChg * avg_pct) {L} END AS mxy, CASE WHEN count(avg_pct * avg_pct) {L} >= 60 THEN avg(avg_pct * avg_pct) {L} END AS my2,
  last_value(zb IGNORE NULLS) {S} AS zb120, last_value(yz IGNORE NULLS) {S} AS yz120 FROM e)"""
TRAIT_COLS = ("lu120", "ld120", "bu120", "bd120", "turn120", "hi", "lo", "dsl", "sru", "srd", "beta120", "zb120", "yz120")


def _raw(names: tuple[str, ...], digits: int | None = 5) -> str:
    own = {"sru": "CASE WHEN bu120 >= 5 THEN lu120 / bu120 END", "srd": "CASE WHEN bd120 >= 5 THEN ld120 / bd120 END", "beta120": "(mxy - mx * my) / nullif(my2 - my * my, 0)"}
    value = {n: f"CAST({own.get(n, n)} AS DOUBLE)" for n in names}
    return f"{TRAITS} SELECT trade_date_idx, code_idx, " + ", ".join(f"{x if digits is None else f'round({x}, {digits})'} AS {n}" for n, x in value.items()) + " FROM f"


def _trait_query(name: str, cols: tuple[str, ...], digits: int = 5) -> None:
    @query(name, _raw(cols, digits))
    def _(v: Inputs):
        return cross.raw_traits(*_trait_inputs(v)).select("trade_date_idx", "code_idx", *[F.round(F.col(c).cast("double"), digits).alias(c) for c in cols])


_trait_query("w09_lag_counts", ("lu120", "ld120", "bu120", "bd120"))
_trait_query("w10_lag_turn", ("turn120",), 9)
_trait_query("w11_range_position", ("hi", "lo"))
_trait_query("w12_conversion", ("sru", "srd"))
_trait_query("w13_days_since_limit", ("dsl",))
_trait_query("w14_rolling_beta", ("beta120",), 3)
_trait_query("w15_event_rates", ("zb120", "yz120"))
_trait_query("c24_float_cap", ("fv",), 4)


def _ranked(names: tuple[str, ...]) -> str:
    """Average ranks from 0 to 1 within each day of raw traits."""
    one = "CASE WHEN {c} IS NULL THEN 0.5 ELSE round(({rank} - 1) / greatest(count({c}) OVER (PARTITION BY trade_date_idx) - 1, 1), 6) END AS {c}"
    raw = _raw(names, None).removeprefix(TRAITS)
    traits = TRAITS.replace("FROM bars", "FROM whole").replace("WITH lim", "WITH whole AS (SELECT * REPLACE (CASE WHEN tradestatus = 1 THEN volume END AS turn) FROM bars), lim", 1)
    return f"{traits}, raw AS ({raw}) SELECT trade_date_idx, code_idx, " + ", ".join(one.format(c=n, rank=AVG_RANK.format(by="trade_date_idx", c=n)) for n in names) + " FROM raw"


# turnover in whole numbers, so that equal means are equal to the last bit and share a rank
@query("w16_traits", _ranked((*TRAIT_COLS, "fv")))
def _(v: Inputs):
    bars, limits, breadth = _trait_inputs(v)
    d = cross.build_traits(bars.withColumn("turn", F.when(F.col("tradestatus") == 1, F.col("volume"))), limits, breadth)
    return d.select("trade_date_idx", "code_idx", *r6(*TRAIT_COLS, "fv"))
