"""Input views derived from the driver tables; the same SQL text runs in Spark and DuckDB."""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "calendar": """
SELECT d AS date, CAST(row_number() OVER (ORDER BY d) - 1 AS INT) AS tdi
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem) t
""",
    "bars": """
WITH t AS (
  SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS d, l_extendedprice / l_quantity AS px,
         l_quantity AS q, l_extendedprice AS v, l_orderkey AS o, l_linenumber AS n
  FROM lineitem),
r AS (
  SELECT t.*, row_number() OVER (PARTITION BY k, d ORDER BY o, n, px) AS ra,
              row_number() OVER (PARTITION BY k, d ORDER BY o DESC, n DESC, px DESC) AS rz
  FROM t),
b AS (
  SELECT k, d, max(CASE WHEN ra = 1 THEN px END) AS open, max(px) AS high, min(px) AS low,
         max(CASE WHEN rz = 1 THEN px END) AS close, sum(q) AS volume, sum(v) AS amount
  FROM r GROUP BY k, d),
c AS (
  SELECT b.*, cal.tdi, CASE WHEN (k * 31 + cal.tdi) % 41 = 0 THEN 0 ELSE 1 END AS tradestatus
  FROM b JOIN (SELECT d AS cd, row_number() OVER (ORDER BY d) - 1 AS tdi
               FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem) x) cal
    ON b.d = cal.cd),
p AS (
  SELECT c.*, lag(close) OVER (PARTITION BY k, tradestatus ORDER BY d) AS prev_close FROM c)
SELECT d AS date,
       concat(CASE k % 5 WHEN 0 THEN 'sh.60' WHEN 1 THEN 'sz.00' WHEN 2 THEN 'sz.30'
                         WHEN 3 THEN 'sh.68' ELSE 'bj.83' END, lpad(CAST(k AS VARCHAR(10)), 4, '0')) AS code,
       open, high, low, close,
       CASE WHEN tradestatus = 1 THEN
         CASE WHEN (k + tdi) % 97 = 0 THEN prev_close * 0.9 ELSE prev_close END END AS preclose,
       CASE WHEN tradestatus = 1 THEN volume ELSE 0 END AS volume,
       CASE WHEN tradestatus = 1 THEN amount ELSE 0 END AS amount,
       CASE WHEN tradestatus = 1 THEN volume / 100.0 END AS turn,
       tradestatus,
       CASE WHEN tradestatus = 1 AND prev_close > 0 THEN
         (close / (CASE WHEN (k + tdi) % 97 = 0 THEN prev_close * 0.9 ELSE prev_close END) - 1) * 100 END AS pctChg,
       CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END AS isST,
       CAST(tdi AS INT) AS trade_date_idx, CAST(k AS INT) AS code_idx
FROM p
""",
    "m15": """
SELECT CAST(ts AS DATE) AS date, slot, user_id AS code, count(*) AS n_ticks, max(value) AS high,
       min(value) AS low, sum(value) AS amount
FROM (SELECT ts, user_id, value,
             CAST(floor((extract(hour FROM ts) * 60 + extract(minute FROM ts)) / 90.0) AS INT) AS slot
      FROM events) t
GROUP BY CAST(ts AS DATE), slot, user_id
""",
    "limit_events": """
SELECT CAST(ts AS DATE) AS date, user_id AS code,
       max(CASE WHEN event_type = 'purchase' THEN 1 ELSE -1 END) AS is_limit_up,
       min(extract(hour FROM ts) * 60 + extract(minute FROM ts)) AS first_min,
       count(*) - 1 AS open_count, max(value) AS seal_pct
FROM events WHERE event_type IN ('purchase', 'error')
GROUP BY CAST(ts AS DATE), user_id
""",
    "theme_events": """
SELECT DISTINCT CAST(l.l_shipdate AS DATE) AS date, l.l_suppkey AS code, p.p_brand AS zscode,
       p.p_type AS zs_name, max(l.l_linenumber) OVER
         (PARTITION BY l.l_shipdate, l.l_suppkey, p.p_brand, p.p_type) AS boards
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
""",
    "seats": """
SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS code,
       CASE WHEN l_returnflag = 'A' THEN 'buy' ELSE 'sell' END AS side,
       l_partkey % 7 AS seat, sum(l_extendedprice) AS amount
FROM lineitem
GROUP BY CAST(l_shipdate AS DATE), l_suppkey,
         CASE WHEN l_returnflag = 'A' THEN 'buy' ELSE 'sell' END, l_partkey % 7
""",
    "news": """
SELECT ts, user_id AS code, CASE WHEN event_type = 'view' THEN 'em' ELSE 'cls' END AS feed, value
FROM events WHERE event_type IN ('view', 'click')
""",
    "announcements": """
SELECT doc_id AS id, doc_id % 150 AS code, text AS title,
       CASE WHEN doc_id % 10 = 0 THEN 34200 ELSE 0 END AS second_of_day, doc_id % 28 + 1 AS day
FROM documents
""",
    "vectors": """
SELECT label AS cell, vec_id, embedding FROM embeddings
""",
    "alias_pairs": """
SELECT name, code_e, count(*) AS n
FROM (SELECT concat('n', CAST(floor(c_custkey / 3) AS INT)) AS name,
             concat('c', CAST(floor(c_custkey / 24) * 8 + c_custkey * 7919 % 5 AS INT)) AS code_e
      FROM customer) t
GROUP BY name, code_e
""",
    "landing": """
SELECT event_id AS id, ts, 1 AS batch, value FROM events WHERE extract(day FROM ts) <= 15
UNION ALL
SELECT event_id AS id, ts, 2 AS batch, value + 1 AS value FROM events WHERE extract(day FROM ts) > 8
""",
}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
