"""Queries: training samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import indicators
from ..operators import samples as s
from .harness import Inputs, query
from .q_indicators import IS_NEW

IDS = "ids AS (SELECT code, date FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY date) AS n FROM bars) x WHERE n >= 30 AND date >= DATE '1996-01-01' AND date < DATE '1997-01-01')"


def _ids(v: Inputs):
    return s.sample_ids(v.bars, 25, 5, "1996-01-01", "1997-01-01")


@query("d01_sample_ids", f"WITH {IDS} SELECT code, date FROM ids")
def _(v: Inputs):
    return _ids(v)


# two 15-minute columns: one with a gap now and then, one that is never there on idle days
@query("d02_gate_windows", f"""WITH {IS_NEW}, g AS (SELECT *, CASE WHEN isST <> 0 OR is_new <> 0 OR (volume > 0 AND (code_idx * 7 + trade_date_idx) % 211 = 0) THEN 1 ELSE 0 END AS b FROM flagged),
s AS (SELECT *, sum(b) OVER w AS bad, count(*) OVER w AS n FROM g WINDOW w AS (PARTITION BY code ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) SELECT code, date FROM s WHERE bad = 0 AND n = 10""")
def _(v: Inputs):
    d = indicators.is_new(v.bars).withColumns({"m15_a": F.when((F.col("code_idx") * 7 + F.col("trade_date_idx")) % 211 > 0, F.col("close")), "m15_b": F.when(F.col("volume") > 0, F.col("amount"))})
    return s.gate_windows(d.withColumn("bad", s.bad_rows(d, ("m15_a", "m15_b"))), "bad", 10).select("code", "date")


@query("d03_tail_samples", "WITH x AS (SELECT *, sum(CASE WHEN isST = 1 THEN 1 ELSE 0 END) OVER w AS bad, count(*) OVER w AS n, max(trade_date_idx) OVER () AS last FROM bars WINDOW w AS (PARTITION BY code ORDER BY date ROWS BETWEEN 28 PRECEDING AND CURRENT ROW)) SELECT code, CAST(trade_date_idx + 1 AS INT) AS trade_date_idx, true AS virtual FROM x WHERE bad = 0 AND n = 29 AND trade_date_idx = last")
def _(v: Inputs):
    d = v.bars.withColumn("bad", F.col("isST") == 1).select("code", "date", "trade_date_idx", "bad")
    return s.tail_samples(d, "bad", 30, 0, 1 << 30).select("code", "trade_date_idx", "virtual")


# with a table by day and one by supplier (codes above 9,999 are cut to four digits) and day, of which every third day and every second supplier lack rows
@query("d04_materialise", f"""WITH {IDS}, j AS (SELECT code, date, coalesce(volume, 0) AS volume, coalesce(CASE WHEN isfinite(turn) THEN turn END, 0) AS turn, CASE WHEN trade_date_idx % 3 > 0 THEN trade_date_idx ELSE -1 END AS heat, CASE WHEN code_idx % 2 = 0 THEN code_idx + trade_date_idx ELSE 0.5 END AS mix FROM bars),
w AS (SELECT code, date, {', '.join(f'list({c}) OVER o AS {c}' for c in ('volume', 'turn', 'heat', 'mix'))} FROM j WINDOW o AS (PARTITION BY code ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT code, date, CAST(len(volume) AS INT) AS n, {', '.join(f'round(list_sum([x * i FOR x, i IN {c}])::DOUBLE, 6) AS {c}' for c in ('volume', 'turn', 'heat', 'mix'))} FROM w SEMI JOIN ids USING (code, date)""")
def _(v: Inputs):
    days = v.calendar.where("tdi % 3 > 0").select("date", F.col("tdi").cast("double").alias("heat"))
    both = v.bars.where("code_idx % 2 = 0").select("code_idx", "date", (F.col("code_idx") + F.col("trade_date_idx")).cast("double").alias("mix"))
    d = s.materialise(_ids(v), v.bars, 5, ["volume", "turn", "heat", "mix", "unknown"], ((days, ("date",), -1.0), (both, ("code_idx", "date"), 0.5)))

    def weighed(c: str):
        """The values by their places, which tells orders apart."""
        return F.round(F.aggregate(F.transform(c, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x), 6).alias(c)

    return d.select("code", "date", F.size("volume").alias("n"), *map(weighed, ("volume", "turn", "heat", "mix")))


# a weekend's end: the validation goes on to the next trading day
@query("d05_split_samples", f"WITH {IDS}, n AS (SELECT min(date) AS e FROM calendar WHERE date > DATE '1996-11-30') SELECT code, date, 'train' AS split FROM ids WHERE date <= DATE '1996-06-15' UNION ALL SELECT code, date, 'validation' FROM ids, n WHERE date >= DATE '1996-06-15' AND date <= e")
def _(v: Inputs):
    return s.split_samples(_ids(v), "1996-01-01", "1996-06-15", "1996-11-30", v.calendar)


@query("d05_train_and_validation", """WITH x AS (SELECT code, date, row_number() OVER (PARTITION BY code ORDER BY date) AS n FROM bars), n AS (SELECT min(date) AS e FROM calendar WHERE date > DATE '1996-11-30')
SELECT code, date, 'train' AS split FROM x WHERE n >= 27 AND date BETWEEN DATE '1995-01-01' AND DATE '1996-06-15' UNION ALL SELECT code, date, 'validation' FROM x, n WHERE x.n >= 30 AND date > DATE '1996-06-15' AND date <= e""")
def _(v: Inputs):
    return s.train_and_validation(v.bars, 25, 5, "1995-01-01", "1996-06-15", "1996-11-30", v.calendar, train_horizon=2, exclusive=True).select("code", "date", "split")


@query("d06_epoch_order")
def _(v: Inputs):
    return s.epoch_order(_ids(v), 7, 2)


@query("d07_assign_batches", f"WITH {IDS}, b AS (SELECT code, date, CAST(floor((row_number() OVER (PARTITION BY date ORDER BY code) - 1) / 8.0) AS INT) AS batch FROM ids), r AS (SELECT *, count(*) OVER (PARTITION BY date, batch) AS n FROM b) SELECT code, date, batch, CAST(unnest([1, 2]) AS INT) AS repeat FROM r WHERE n = 8")
def _(v: Inputs):
    return s.assign_batches(_ids(v), 8, repeats=2, drop_last=True)


@query("d07_ordered_batches", f"WITH {IDS}, b AS (SELECT code, date, (row_number() OVER (ORDER BY date, code) - 1) // 64 AS batch, count(*) OVER () AS n FROM ids) SELECT code, date, CAST(batch AS BIGINT) AS batch FROM b WHERE (batch + 1) * 64 <= n AND batch >= 3 AND batch < 103")
def _(v: Inputs):
    return s.ordered_batches(_ids(v), 64, drop_last=True, skip=3, limit=100).select("code", "date", "batch")


def _mean(p):
    return p.groupby(["date", "batch"], as_index=False).agg(n=("code", "size"))


@query("d08_map_batches", f"WITH {IDS}, b AS (SELECT date, CAST(floor((row_number() OVER (PARTITION BY date ORDER BY code) - 1) / 8.0) AS INT) AS batch FROM ids) SELECT date, batch, count(*) AS n FROM b GROUP BY ALL")
def _(v: Inputs):
    return s.map_batches(s.assign_batches(_ids(v), 8), _mean, "date date, batch int, n long", per_call=1024)


@query("d09_feature_view", "SELECT code, date, round(volume, 6) AS volume FROM bars WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'")
def _(v: Inputs):
    return s.feature_view(v.bars, "1996-01-01", "1996-03-31", ["volume", "none"]).withColumn("volume", F.round("volume", 6))


# a key has up to three side rows, of which that with the smallest theme counts
@query("j01_lookup_with_default", "WITH s AS (SELECT code, date, trade_date_idx % 10 + k * 100 AS x, (code_idx + k * 2) % 3 AS theme FROM bars, range(3) r(k) WHERE trade_date_idx % 3 = 0), o AS (SELECT code, date, min_by(x, theme) AS x, min(theme) AS theme FROM s GROUP BY ALL) SELECT b.code, b.date, coalesce(CAST(x AS DOUBLE), 0.5) AS x, coalesce(CAST(theme AS DOUBLE), 0.5) AS theme FROM bars b LEFT JOIN o ON b.code = o.code AND b.date = o.date")
def _(v: Inputs):
    side = v.bars.where("trade_date_idx % 3 = 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    side = side.select("code", "date", (F.col("trade_date_idx") % 10 + F.col("k") * 100).cast("double").alias("x"), ((F.col("code_idx") + F.col("k") * 2) % 3).cast("double").alias("theme"))
    return s.lookup_with_default(v.bars.select("code", "date"), side, ["code", "date"], 0.5, ["theme"])
