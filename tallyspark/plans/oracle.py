"""DuckDB SQL twins of the registered queries.

Each text runs on the pre-registered views (one per driver table) and must
give the same rows, column names and values as the Spark query with the
same key.  Shared derivations are CTE fragments mirroring ``inputs.py``.
"""

from __future__ import annotations

# Transactions derived from events (mirrors inputs.transactions).
TX = """tx AS (
  SELECT CAST(user_id AS VARCHAR) AS "User ID",
         CAST(event_id AS VARCHAR) AS "Transaction ID",
         CAST(value AS DECIMAL(18,2)) AS "Amount",
         event_type AS "Vendor",
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS VARCHAR) AS "Sources",
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS "Time",
         CAST(ts AS DATE) AS date
  FROM events)"""

# Flat change rows (mirrors inputs.change_rows).
CH = """ch AS (
  SELECT CAST(event_id // 3 AS BIGINT) AS id,
         CASE WHEN event_id % 10 = 0 THEN 'd' WHEN event_id % 10 < 3 THEN 'u' ELSE 'c' END AS op,
         epoch_us(ts) // 1000 AS ts_ms,
         event_id AS lsn,
         CAST(user_id AS VARCHAR) AS "User ID",
         CAST(event_id AS VARCHAR) AS "Transaction ID",
         value AS "Amount",
         event_type AS "Vendor",
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS VARCHAR) AS "Sources",
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS "Time"
  FROM events)"""


# The same with the amount as double (row-level queries).
TXD = TX.replace('CAST(value AS DECIMAL(18,2)) AS "Amount"', 'value AS "Amount"')

PURCHASE_KEYS = """SELECT DISTINCT "User ID" AS user_id FROM tx
  WHERE date = DATE '2024-01-20' AND "Vendor" = 'purchase'"""

DEMO = """demo AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, n_name AS location,
                        c_mktsegment AS occupation, c_acctbal AS balance
                 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

_TS = """CAST(strptime("Time", '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)"""
SLICES = f"""{TXD},
feed AS (SELECT *, {_TS} AS timestamp FROM tx),
snap AS (SELECT CAST("Transaction ID" AS BIGINT) AS id, *, {_TS} AS timestamp FROM tx)"""

CAL = """cal AS (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS agg_date,
                       CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)"""
CAL_MEASURES = """CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price,
  CAST(SUM(price) AS DOUBLE) AS total_volume, COUNT(price) AS total_trades"""


def feature_select(key: str = '"User ID"', label: str = "l1w") -> str:
    return f"""{key} AS user_id,
  COUNT("Transaction ID") AS num_transactions_{label},
  CAST(SUM("Amount") AS DOUBLE) AS total_amount_{label},
  CAST(SUM("Amount") AS DOUBLE) / COUNT("Amount") AS avg_amount_{label},
  CAST(MIN("Amount") AS DOUBLE) AS min_amount_{label},
  CAST(MAX("Amount") AS DOUBLE) AS max_amount_{label},
  COUNT(DISTINCT "Vendor") AS num_vendors_{label},
  COUNT(DISTINCT "Sources") AS num_sources_{label}"""


WEEKLY = f"""WITH {TX}
SELECT {feature_select()}, DATE '2024-01-20' AS date
FROM tx WHERE date BETWEEN DATE '2024-01-13' AND DATE '2024-01-20'
GROUP BY "User ID" """

# Backfilled feature table (mirrors catalog.feature_table: 2024-01-08..30).
FT = f"""{TX},
runs AS (SELECT CAST(r AS DATE) AS run FROM range(DATE '2024-01-08', DATE '2024-01-31', INTERVAL 1 DAY) t(r)),
ft AS (SELECT {feature_select()}, runs.run AS date
       FROM tx JOIN runs ON tx.date BETWEEN runs.run - 7 AND runs.run
       GROUP BY "User ID", runs.run)"""
BACKFILL = f"WITH {FT} SELECT * FROM ft"

FEATS = ("num_transactions_l1w", "total_amount_l1w", "avg_amount_l1w", "min_amount_l1w",
         "max_amount_l1w", "num_vendors_l1w", "num_sources_l1w")
VIEW_TYPES = ("BIGINT", "FLOAT", "FLOAT", "FLOAT", "FLOAT", "BIGINT", "BIGINT")
PROJECTED = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in zip(FEATS, VIEW_TYPES))

# View projection of the feature table, newest row per user up to a date.
PROJ = f"""{FT}, proj AS (SELECT user_id, date, {PROJECTED} FROM ft)"""
ONLINE = f"""{PROJ},
online AS (SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS rk
  FROM proj WHERE date <= DATE '2024-01-30') WHERE rk = 1)"""

# Entity rows and the as-of join (DuckDB ASOF: newest f.fts <= event time).
ASOF_BASE = f"""{PROJ},
f AS (SELECT user_id, CAST(date AS TIMESTAMP) AS fts, num_transactions_l1w, total_amount_l1w,
             num_vendors_l1w FROM proj),
e AS (SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS event_timestamp FROM events)"""
ASOF = f"""WITH {ASOF_BASE}
SELECT e.user_id, e.event_timestamp, f.num_transactions_l1w, f.total_amount_l1w, f.num_vendors_l1w
FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.event_timestamp >= f.fts"""
_TTL_OK = "f.fts >= e.event_timestamp - INTERVAL 12 HOUR"
ASOF_TTL = f"""WITH {ASOF_BASE}
SELECT e.user_id, e.event_timestamp,
  CASE WHEN {_TTL_OK} THEN f.num_transactions_l1w END AS num_transactions_l1w,
  CASE WHEN {_TTL_OK} THEN f.total_amount_l1w END AS total_amount_l1w,
  CASE WHEN {_TTL_OK} THEN f.num_vendors_l1w END AS num_vendors_l1w
FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.event_timestamp >= f.fts"""
MULTI_VIEW = f"""WITH {ASOF_BASE},
demo AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, n_name AS location, c_mktsegment AS occupation
         FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT e.user_id, e.event_timestamp, f.num_transactions_l1w, f.total_amount_l1w, f.num_vendors_l1w,
       demo.location, demo.occupation
FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.event_timestamp >= f.fts
LEFT JOIN demo ON e.user_id = demo.user_id"""

ROW = '"User ID", "Transaction ID", "Amount", "Vendor", "Sources", "Time"'
LATEST_UP = f"""WITH {CH},
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, lsn DESC) AS rk
           FROM ch WHERE op IN ('c', 'u', 'r'))"""
CURRENT = f"""{LATEST_UP}
SELECT op, id, {ROW}, ts_ms, lsn FROM ranked
WHERE rk = 1 AND id NOT IN (SELECT id FROM ch WHERE op = 'd')"""

_EXACT = ("num_transactions_l1w", "total_amount_l1w", "min_amount_l1w", "max_amount_l1w",
          "num_vendors_l1w", "num_sources_l1w")
_BAD = " + ".join([f"(CASE WHEN w.{c} IS NOT DISTINCT FROM s.{c} THEN 0 ELSE 1 END)" for c in _EXACT]
                  + ["(CASE WHEN (w.avg_amount_l1w IS NULL AND s.avg_amount_l1w IS NULL) OR "
                     "abs(w.avg_amount_l1w - s.avg_amount_l1w) <= 0.001 THEN 0 ELSE 1 END)"])
COMPARE = f"""WITH {FT},
w AS (SELECT * FROM ({WEEKLY.replace('WITH ' + TX, '', 1)}) WHERE NOT ends_with(user_id, '3')),
s AS (SELECT * REPLACE (
        CASE WHEN ends_with(user_id, '5') THEN total_amount_l1w + 1 ELSE total_amount_l1w END AS total_amount_l1w,
        CASE WHEN ends_with(user_id, '4') THEN avg_amount_l1w + 0.5 ELSE avg_amount_l1w END AS avg_amount_l1w)
      FROM ft WHERE date = DATE '2024-01-20' AND NOT ends_with(user_id, '7'))
SELECT COALESCE(w.user_id, s.user_id) AS user_id,
       w.user_id IS NOT NULL AS in_left, s.user_id IS NOT NULL AS in_right,
       CAST({_BAD} AS BIGINT) AS n_mismatch,
       (w.user_id IS NOT NULL AND s.user_id IS NOT NULL AND ({_BAD}) = 0) AS matches
FROM w FULL OUTER JOIN s ON w.user_id = s.user_id"""

# Stream windows closed by the watermark (max event second - 1 day):
# run dates whose window end (run + 1 day) is at or before it.
STREAM_FT = f"""WITH {TX},
wm AS (SELECT date_trunc('second', max(ts)) - INTERVAL 1 DAY AS w FROM events),
runs AS (SELECT CAST(r AS DATE) AS run FROM range(DATE '2023-12-20', DATE '2024-02-10', INTERVAL 1 DAY) t(r)
         WHERE CAST(r AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT w FROM wm))
SELECT {feature_select()}, runs.run AS date
FROM tx JOIN runs ON tx.date BETWEEN runs.run - 7 AND runs.run
GROUP BY "User ID", runs.run"""

PARTS = "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part"

SQL: dict[str, str] = {
    "stream_window_features": STREAM_FT,
    "stream_current_state": CURRENT,
    "distinct_dates": f"WITH {TXD} SELECT DISTINCT date FROM tx WHERE date IS NOT NULL",
    "date_gate": f"""WITH {TXD} SELECT COUNT(DISTINCT date) AS n_dates FROM tx
WHERE date BETWEEN DATE '2024-01-13' AND DATE '2024-01-20' AND date IS NOT NULL""",
    "gate_run_dates": f"""WITH {TXD},
present AS (SELECT DISTINCT date FROM tx WHERE NOT (day(date) % 3 = 0 AND date < DATE '2024-01-20')),
runs AS (SELECT CAST(r AS DATE) AS run FROM range(DATE '2024-01-08', DATE '2024-01-31', INTERVAL 1 DAY) t(r))
SELECT run AS date, COUNT(p.date) AS n_dates, COUNT(p.date) >= 7 AS complete
FROM runs LEFT JOIN present p ON p.date BETWEEN run - 7 AND run GROUP BY run""",
    "filter_not_null": f"""WITH {TXD} SELECT * FROM tx
WHERE CAST("Transaction ID" AS BIGINT) % 5 <> 0 AND CAST("Transaction ID" AS BIGINT) % 7 <> 0
  AND ("Vendor" = 'click' OR "Sources" = '1')""",
    "feature_timestamp": f"SELECT *, TIMESTAMP '2024-01-21 06:00:00' AS feature_timestamp FROM ({WEEKLY})",
    "date_texts": """WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders),
u AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN replace(d, '-', '/') WHEN 1 THEN d[1:5] || '13-45' ELSE d END
             AS text, o_orderkey % 4 >= 2 AS valid, d FROM t)
SELECT o_orderkey, text, CASE WHEN valid THEN CAST(d AS DATE) END AS day, valid FROM u""",
    "catalog_table": f"WITH {TXD} SELECT * FROM tx WHERE date BETWEEN DATE '2024-01-13' AND DATE '2024-01-20'",
    "registered_history": ASOF,
    "registered_online": f"""WITH {ONLINE}
SELECT *, CAST(1 AS BIGINT) AS materialization_run, 'customer_features' AS "view" FROM online""",
    "stream_late_and_duplicates": """WITH ev AS (SELECT event_id, ts, CAST(value AS DECIMAL(18,2)) AS value FROM events),
near AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21' AND event_id % 13 = 0),
late AS (SELECT * FROM ev WHERE ts < TIMESTAMP '2024-01-15' AND event_id % 11 = 0),
marks AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY AS last,
                 date_trunc('millisecond', max(ts) FILTER (ts < TIMESTAMP '2024-01-21')) - INTERVAL 2 DAY AS first FROM ev),
taken AS (SELECT * FROM ev UNION ALL SELECT * FROM near
          UNION ALL SELECT late.* FROM late, marks WHERE late.ts > marks.first)
SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n_rows, CAST(SUM(value) AS DOUBLE) AS total,
       (SELECT COUNT(*) FROM late, marks WHERE late.ts <= marks.first) AS n_dropped
FROM taken, marks GROUP BY day, last HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= last""",
    "row_count": "SELECT COUNT(*) AS n_rows FROM events",
    "filter_date": f"WITH {TXD} SELECT * FROM tx WHERE date = DATE '2024-01-20'",
    "filter_range": f"WITH {TXD} SELECT * FROM tx WHERE date BETWEEN DATE '2024-01-13' AND DATE '2024-01-20'",
    "filter_keys": f"""WITH {TXD} SELECT * FROM tx WHERE "User ID" IN ({PURCHASE_KEYS})""",
    "inner_join_keys": f"""WITH {FT}, k AS ({PURCHASE_KEYS})
SELECT ft.* FROM ft JOIN k ON ft.user_id = k.user_id WHERE ft.date = DATE '2024-01-20'""",
    "first_rows": f"WITH {DEMO} SELECT * FROM demo ORDER BY user_id LIMIT 10",
    "top_n": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5",
    "compare_features": COMPARE,
    "union_by_name": f"WITH {SLICES} SELECT * FROM feed UNION ALL BY NAME SELECT * FROM snap",
    "union_dedup": f"""WITH {SLICES},
u AS (SELECT * FROM feed UNION ALL BY NAME SELECT * FROM snap),
r AS (SELECT *, row_number() OVER (PARTITION BY "Transaction ID"
                                   ORDER BY timestamp DESC NULLS LAST, id DESC NULLS LAST) AS rk FROM u)
SELECT * EXCLUDE (rk) FROM r WHERE rk = 1""",
    "update_where": f"""WITH {TXD}
SELECT * REPLACE (CASE WHEN "Vendor" = 'click' AND "Sources" = '1' THEN '0' ELSE "Sources" END AS "Sources")
FROM tx""",
    "rows_to_json": f"WITH {DEMO} SELECT user_id AS key, * FROM demo",
    "scalar_dates": """SELECT event_id,
  CAST(date_trunc('second', ts) AS DATE) AS day,
  CAST(ts AS DATE) AS day2,
  CAST(ts AS DATE) - 7 AS week_ago,
  CAST(weekofyear(ts) AS INTEGER) AS week_number,
  CAST(month(ts) AS INTEGER) AS month,
  CAST(hour(ts) AS INTEGER) AS hour,
  epoch_us(date_trunc('second', ts)) // 1000 AS epoch_ms,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS back_text,
  strftime(ts, '%Y%m%d') AS day_compact,
  replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', '') AS day_compact2,
  CAST(ts + INTERVAL 7 HOUR AS DATE) AS local_day
FROM events""",
    "scalar_strings": """SELECT p_partkey,
  lower(p_name) AS name_lower,
  ends_with(lower(p_name), 'bolt') AS is_bolt,
  contains(p_name, 'red') AS has_red,
  string_split(p_name, ' ')[1] AS first_word,
  string_split(p_name, ' ')[2] AS second_word,
  regexp_replace(p_brand, '#', '-', 'g') AS brand_code,
  CAST(p_size AS VARCHAR) AS size_text,
  CAST(p_size AS BIGINT) - 1 AS size_minus_one,
  CAST(p_retailprice AS FLOAT) AS price_f32,
  p_type AS type_from_map,
  false AS has_size
FROM part""",
    "filter_suffix": "SELECT * FROM part WHERE ends_with(lower(p_name), 'bolt')",
    "stream_calendar_weekly": f"""WITH {CAL}
SELECT symbol, CAST(weekofyear(agg_date) AS BIGINT) AS week_number, {CAL_MEASURES}
FROM cal GROUP BY ALL""",
    "weekofyear_agg": f"""WITH {CAL}
SELECT symbol, CAST(weekofyear(agg_date) AS BIGINT) AS week_number, {CAL_MEASURES}
FROM cal GROUP BY ALL""",
    "stream_calendar_monthly": f"""WITH {CAL}
SELECT symbol, CAST(month(agg_date) AS BIGINT) AS month, {CAL_MEASURES}
FROM cal GROUP BY ALL""",
    "week_trunc_agg": f"""WITH {CAL}
SELECT symbol, CAST(date_trunc('week', agg_date) AS DATE) AS week_start, {CAL_MEASURES}
FROM cal GROUP BY ALL""",
    "month_agg": f"""WITH {CAL}
SELECT symbol, CAST(month(agg_date) AS BIGINT) AS month, {CAL_MEASURES}
FROM cal GROUP BY ALL""",
    "keep_last": """SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rk
  FROM orders) WHERE rk = 1""",
    "json_records": """SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
  o_totalprice AS price_daily, o_totalprice * 2 AS volume_daily, CAST(o_custkey AS INTEGER) AS trades_daily
FROM orders""",
    "candle_shape": """SELECT regexp_replace(upper(o_orderpriority), '[^A-Z]', '', 'g') || 'USDT' AS symbols,
  o_totalprice + 1 AS lastPrice, o_totalprice + 10 AS highPrice, o_totalprice - 10 AS lowPrice,
  o_totalprice * 2 AS quoteVolume, CAST(o_custkey AS INTEGER) AS count,
  strftime(o_orderdate + INTERVAL 3599999 MILLISECOND, '%Y-%m-%d') AS date,
  CAST(hour(o_orderdate + INTERVAL 3599999 MILLISECOND) AS INTEGER) AS hour
FROM orders""",
    "feature_projection": f"WITH {PROJ} SELECT * FROM proj",
    "latest_features": f"""WITH {FT}, r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS rk FROM ft
  WHERE date > DATE '2024-01-15' AND date <= DATE '2024-01-25')
SELECT * EXCLUDE (rk) FROM r WHERE rk = 1""",
    "materialize_full": f"WITH {ONLINE} SELECT * FROM online",
    # Runs: 1 up to the middle, 2 up to the end, 3 late rows up to the middle
    # (users ending in 1 under another name; the others' rows again), 4 the
    # slice of run 2 again, its last day corrected for users ending in 3.
    "materialize_incremental": f"""WITH {FT},
feeds AS (
  SELECT 1 AS run, * FROM ft WHERE date <= DATE '2024-01-20'
  UNION ALL SELECT 2, * FROM ft WHERE date > DATE '2024-01-20'
  UNION ALL SELECT 3, * REPLACE (CASE WHEN ends_with(user_id, '1') THEN 'late-' || user_id ELSE user_id END AS user_id)
  FROM ft WHERE date <= DATE '2024-01-20'
  UNION ALL SELECT 4, * REPLACE (
    num_transactions_l1w - CASE WHEN date = DATE '2024-01-30' AND ends_with(user_id, '3') THEN 1 ELSE 0 END
      AS num_transactions_l1w,
    total_amount_l1w - CASE WHEN date = DATE '2024-01-30' AND ends_with(user_id, '3') THEN 5 ELSE 0 END
      AS total_amount_l1w)
  FROM ft WHERE date > DATE '2024-01-20')
SELECT user_id, date, {PROJECTED}, CAST(run AS BIGINT) AS materialization_run FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC, run DESC) AS rk FROM feeds) WHERE rk = 1""",
    "partition_rerun": f"""WITH {TXD} SELECT * FROM tx
WHERE date <> DATE '2024-01-20' OR "Vendor" = 'purchase'""",
    "partition_range": f"WITH {TXD} SELECT * FROM tx WHERE date BETWEEN DATE '2024-01-13' AND DATE '2024-01-20'",
    "update_table": f"""WITH {TXD}
SELECT * REPLACE (CASE WHEN "Vendor" = 'click' AND date >= DATE '2024-01-20' THEN '0' ELSE "Sources" END AS "Sources")
FROM tx""",
    "csv_round_trip": PARTS,
    "json_round_trip": PARTS,
    "text_round_trip": "SELECT p_name AS value, COUNT(*) AS n FROM part GROUP BY p_name",
    "feature_schema_check": """WITH t AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority[1:2] END AS priority,
         CAST(o_totalprice AS VARCHAR) AS price, o_orderstatus AS status FROM orders)
SELECT 'user_id' AS "column", 'key' AS role, 'string' AS expected_type, COUNT(*) AS n_rows,
       COUNT(*) FILTER (user_id IS NULL) AS n_null, CAST(0 AS BIGINT) AS n_uncastable FROM t
UNION ALL SELECT 'priority', 'feature', 'bigint', COUNT(*), COUNT(*) FILTER (priority IS NULL),
       COUNT(*) FILTER (priority IS NOT NULL AND TRY_CAST(priority AS BIGINT) IS NULL) FROM t
UNION ALL SELECT 'price', 'feature', 'double', COUNT(*), COUNT(*) FILTER (price IS NULL),
       COUNT(*) FILTER (price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL) FROM t
UNION ALL SELECT 'status', 'feature', 'string', COUNT(*), COUNT(*) FILTER (status IS NULL), 0 FROM t""",
    "online_lookup": f"""WITH {ONLINE}
SELECT CAST(c_custkey AS VARCHAR) AS user_id, online.num_transactions_l1w, online.total_amount_l1w,
       online.num_vendors_l1w
FROM customer LEFT JOIN online ON CAST(c_custkey AS VARCHAR) = online.user_id""",
    "online_lookup_rows": f"""WITH {ONLINE},
k AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer ORDER BY user_id LIMIT 20)
SELECT k.user_id, online.num_transactions_l1w, online.total_amount_l1w, online.num_vendors_l1w
FROM k LEFT JOIN online ON k.user_id = online.user_id""",
    "pandas_round_trip": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 100",
    "asof_features": ASOF,
    "asof_features_ttl": ASOF_TTL,
    "multi_view_features": MULTI_VIEW,
    "cdc_parse": f"WITH {CH} SELECT id, op, ts_ms, lsn, {ROW} FROM ch",
    "cdc_parse_two_step": f"WITH {CH} SELECT id, op, ts_ms, lsn, {ROW} FROM ch",
    "cdc_upserts": f"WITH {CH} SELECT op, id, {ROW}, ts_ms, lsn FROM ch WHERE op IN ('c', 'u', 'r')",
    "cdc_deletes": f"WITH {CH} SELECT id FROM ch WHERE op = 'd'",
    "cdc_latest": f"{LATEST_UP} SELECT op, id, {ROW}, ts_ms, lsn FROM ranked WHERE rk = 1",
    "cdc_anti_join": CURRENT,
    "cdc_current_latest": f"""WITH {CH},
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, lsn DESC) AS rk FROM ch)
SELECT op, id, {ROW}, ts_ms, lsn FROM ranked WHERE rk = 1 AND op <> 'd'""",
    "cdc_ingest_day": f"""WITH cur AS ({CURRENT})
SELECT op, {ROW}, CAST(strptime("Time", '%Y-%m-%d %H:%M:%S') AS DATE) AS date FROM cur
WHERE CAST(strptime("Time", '%Y-%m-%d %H:%M:%S') AS DATE) = DATE '2024-01-20'""",
    "weekly_features": WEEKLY,
    "backfill_features": BACKFILL,
}
