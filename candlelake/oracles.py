"""DuckDB oracles: for each registered query, SQL over the same parquet tables (views
``orders``, ``customer``, ...) that must give the same rows, columns and types.

The SQL derives the expected result straight from the tables and the fixture rules (it never
parses JSON): bars from orders, junk days as NULLs, one copy per (bar, run), the incremental
scenario of ``queries``. Return percentages use exact integer arithmetic with half-away-from-
zero rounding, which is what decimal HALF_UP rounding in Spark gives.
"""

from __future__ import annotations

from .constants import LOOKBACK_DAYS
from .queries import CUT_DAYS, HOLE_DAYS, LATE_DAYS, PER_KEY_DEAD, PER_KEY_LATE
from .sources.fixtures import FETCH_DAY


def pct_sql(open_: str, close: str) -> str:
    o = f"CAST({open_} * 10000 AS BIGINT)"
    n = f"((CAST({close} * 10000 AS BIGINT) - {o}) * 10000)"
    k = f"(sign({n}) * sign({o}) * ((2 * abs({n}) + abs({o})) // (2 * abs({o}))))"
    return f"TRY_CAST(CAST(CASE WHEN {o} = 0 THEN NULL ELSE {k} END AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,4))"


def candle_sql(open_: str, close: str) -> str:
    return f"CASE WHEN {close} > {open_} THEN 'Bullish' ELSE 'Bearish' END"


CTE = f"""
WITH ticks AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS bar_date, o_orderkey AS seq, o_totalprice AS price FROM orders
  UNION ALL
  SELECT printf('C%07d', o_custkey), CAST(o_orderdate AS DATE), o_orderkey, o_totalprice FROM orders
),
bars AS (
  SELECT symbol, bar_date,
         CAST(arg_min(price, seq) AS DECIMAL(10,4)) AS open,
         CAST(max(price) AS DECIMAL(10,4)) AS high,
         CAST(min(price) AS DECIMAL(10,4)) AS low,
         CAST(arg_max(price, seq) AS DECIMAL(10,4)) AS close,
         count(*) AS volume
  FROM ticks GROUP BY symbol, bar_date
),
landed AS (
  SELECT symbol, bar_date,
         CASE WHEN day(bar_date) = 13 THEN NULL ELSE open END AS open,
         CASE WHEN day(bar_date) = 29 THEN NULL ELSE high END AS high,
         low, close,
         CASE WHEN day(bar_date) = 17 THEN NULL ELSE volume END AS volume,
         open AS raw_open
  FROM bars
),
copies AS (
  SELECT *, CAST(date_trunc('month', bar_date) + INTERVAL 1 MONTH AS DATE) + {FETCH_DAY - 1} AS run_date FROM landed
  UNION ALL
  SELECT *, CAST(date_trunc('month', bar_date) + INTERVAL 2 MONTH AS DATE) + {FETCH_DAY - 1} AS run_date FROM landed
  WHERE bar_date >= CAST(date_trunc('month', bar_date) + INTERVAL 1 MONTH AS DATE) - {LOOKBACK_DAYS}
),
docs AS (SELECT symbol, run_date, count(*) AS n_days, min(bar_date) AS first_day FROM copies GROUP BY symbol, run_date),
gold AS (
  SELECT symbol, bar_date, open, high, low, close, volume,
         TRY_CAST(round(high - low, 2) AS DECIMAL(10,4)) AS daily_range,
         {pct_sql('open', 'close')} AS daily_return_pct,
         {candle_sql('open', 'close')} AS candle
  FROM landed
),
bounds AS (SELECT max(bar_date) AS d_max, min(symbol) AS hole_symbol FROM bars),
existing AS (
  SELECT * FROM gold
  WHERE bar_date < (SELECT d_max FROM bounds) - {CUT_DAYS}
    AND NOT (symbol = (SELECT hole_symbol FROM bounds) AND bar_date >= (SELECT d_max FROM bounds) - {CUT_DAYS + HOLE_DAYS})
),
mark AS (SELECT max(bar_date) AS m FROM existing),
window_rows AS (SELECT * FROM gold WHERE bar_date >= (SELECT m FROM mark) - {LOOKBACK_DAYS}),
window_new AS (
  SELECT w.* FROM window_rows w
  WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.symbol = w.symbol AND e.bar_date = w.bar_date)
),
symbols AS (SELECT DISTINCT symbol, d_max FROM bars, bounds),
employees AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS department,
         CAST(c_acctbal AS DECIMAL(10,2)) AS salary, DATE '2020-01-01' + c_nationkey AS join_date
  FROM customer
)
"""

BARS = "symbol, bar_date, open, high, low, close, volume"
TARGET = BARS + ", daily_range, daily_return_pct, candle"
BRONZE = "symbol, strftime(bar_date, '%Y-%m-%d') AS bar_date, open, high, low, close, volume, run_date"

_null_checks = " UNION ALL ".join(
    f"SELECT 'not_null' AS \"check\", '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS failures FROM copies"
    for c in ("open", "high", "low", "close", "volume")
)

_nulls = ", ".join(f"CAST(coalesce(count_if({c} IS NULL), 0) AS BIGINT) AS null_{c}" for c in ("open", "high", "low", "close", "volume"))

SQL: dict[str, str] = {
    "envelope_status": f"""
SELECT symbol, run_date, 200 AS http_status, 'ok' AS status FROM docs
UNION ALL
SELECT symbol, run_date, CASE WHEN month(run_date) = 12 THEN 503 ELSE 200 END AS http_status,
       CASE month(run_date) WHEN 3 THEN 'rate_limited' WHEN 6 THEN 'api_error'
            WHEN 9 THEN 'missing_series' ELSE 'http_error' END AS status
FROM docs WHERE month(run_date) IN (3, 6, 9, 12)""",
    "bronze_flatten": f"SELECT {BRONZE} FROM copies",
    "landing_roundtrip": f"SELECT {BRONZE} FROM copies",
    "silver_parse": "SELECT symbol, bar_date, open, high, low, close, volume, run_date FROM copies",
    "json_key_last_wins": """
SELECT c.symbol, c.run_date, strftime(c.bar_date, '%Y-%m-%d') AS bar_date,
       CAST(CASE WHEN c.bar_date = d.first_day THEN 2 ELSE 1 END AS BIGINT) AS n_entries,
       CASE WHEN c.bar_date = d.first_day THEN c.raw_open ELSE c.close END AS close_first,
       c.close, c.volume
FROM copies c JOIN docs d ON c.symbol = d.symbol AND c.run_date = d.run_date""",
    "landing_merge": """
SELECT symbol, run_date, CAST(CASE WHEN month(run_date) IN (3, 6, 9, 12) THEN 2 ELSE 1 END AS BIGINT) AS n_attempts,
       CAST(1 AS BIGINT) AS n_ok, 'ok' AS status, 200 AS http_status
FROM docs""",
    "scalar_functions": f"""
SELECT symbol, run_date, 200 AS http_status, false AS has_information, false AS has_error_message,
       2 AS n_keys, CAST(n_days + 1 AS INTEGER) AS n_series_entries,
       strftime(run_date, '%Y-%m-%d') AS run_label, run_date AS run_parsed, run_date - {LOOKBACK_DAYS} AS lookback_from,
       printf('{{"symbol":"%s","http_status":200}}', symbol) AS as_json
FROM docs
UNION ALL
SELECT symbol, run_date, CASE WHEN month(run_date) = 12 THEN 503 ELSE 200 END,
       month(run_date) = 3, month(run_date) IN (3, 6),
       CASE month(run_date) WHEN 3 THEN 2 WHEN 12 THEN 0 ELSE 1 END, 0,
       strftime(run_date, '%Y-%m-%d'), run_date, run_date - {LOOKBACK_DAYS},
       printf('{{"symbol":"%s","http_status":%d}}', symbol, CASE WHEN month(run_date) = 12 THEN 503 ELSE 200 END)
FROM docs WHERE month(run_date) IN (3, 6, 9, 12)""",
    "landing_winner": """
SELECT symbol, run_date, 200 AS http_status, 'ok' AS status, CAST(n_days + 1 AS INTEGER) AS n_series_entries FROM docs""",
    "rejected_rows": """
SELECT symbol, d_max + 40 AS run_date, '2024-1-5' AS bar_date, 'bad_date' AS reason FROM symbols
UNION ALL SELECT symbol, d_max + 40, strftime(d_max + 1, '%Y-%m-%d'), 'bad_day' FROM symbols
UNION ALL SELECT symbol, d_max + 40, strftime(d_max + 2, '%Y-%m-%d'), 'bad_day' FROM symbols
UNION ALL SELECT symbol, d_max + 41, NULL, 'unparseable_body' FROM symbols""",
    # rough landing: one bad date, two copies of d_max + 3, one of d_max + 4 for every symbol
    "dq_report_rejects": f"""
SELECT "check", "column", failures, CASE WHEN failures > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (
  {_null_checks}
  UNION ALL
  SELECT 'unique_key', 'symbol,bar_date', CAST(count(*) AS BIGINT) + (SELECT count(*) FROM symbols)
  FROM (SELECT symbol, bar_date FROM copies GROUP BY symbol, bar_date HAVING count(*) > 1)
  UNION ALL SELECT 'valid_key', 'symbol,bar_date', (SELECT count(*) FROM symbols)
)""",
    # reload: the last fetched copy of d_max + 3 (3.5); incremental run and stream: the first loaded (1.5)
    "load_paths_agree": """
SELECT load_path, (SELECT count(*) FROM gold) + 2 * n AS n_rows, (SELECT count(*) FROM gold) + 2 * n AS n_keys,
       CAST((SELECT sum(close) FROM gold) + n * (2.5 + value) AS DECIMAL(38,4)) AS sum_close, d_max + 4 AS latest,
       n AS n_unparseable_body, 2 * n AS n_bad_day, n AS n_bad_date, CAST(0 AS BIGINT) AS n_null_symbol
FROM (SELECT count(*) AS n, max(d_max) AS d_max FROM symbols),
     (VALUES ('reload', 3.5), ('incremental', 1.5), ('stream', 1.5)) AS p(load_path, value)""",
    "merged_document_flatten": f"SELECT {BRONZE} FROM copies",
    "future_dates": """
SELECT load_path, (SELECT count(*) FROM gold) + 2 * n AS n_rows, d_max + 10 AS latest, d_max + 10 AS mark, n AS n_future_date, n AS n_rejects
FROM (SELECT count(*) AS n, max(d_max) AS d_max FROM symbols), (VALUES ('reload'), ('incremental'), ('stream')) AS p(load_path)""",
    "load_paths_revised": """
SELECT load_path, (SELECT count(*) FROM gold) + 2 * n AS n_rows, (SELECT count(*) FROM gold) + 2 * n AS n_keys,
       CAST((SELECT sum(close) FROM gold) + n * (2.5 + 3.5) AS DECIMAL(38,4)) AS sum_close, d_max + 4 AS latest, CAST(0 AS BIGINT) AS n_differing, n AS n_changed
FROM (SELECT count(*) AS n, max(d_max) AS d_max FROM symbols), (VALUES ('reload'), ('incremental'), ('stream')) AS p(load_path)""",
    # the second reload has the revision of d_max + 3 and lacks the run with d_max + 4
    "load_diff": """
SELECT symbol, d_max + 3 AS bar_date, 'changed' AS difference FROM symbols
UNION ALL SELECT symbol, d_max + 4, 'only_left' FROM symbols""",
    "coverage_gaps": """
, calendar AS (SELECT bar_date, row_number() OVER (ORDER BY bar_date) AS k FROM (SELECT DISTINCT bar_date FROM existing)),
numbered AS (SELECT symbol, k FROM existing JOIN calendar USING (bar_date)),
closed AS (SELECT symbol, k FROM numbered UNION ALL SELECT symbol, (SELECT max(k) + 1 FROM calendar) FROM (SELECT DISTINCT symbol FROM numbered)),
jumps AS (SELECT symbol, k, lag(k) OVER (PARTITION BY symbol ORDER BY k) AS before FROM closed)
SELECT symbol, a.bar_date AS from_date, b.bar_date AS to_date, j.k - before - 1 AS days FROM (SELECT * FROM jumps WHERE k - before > 1) j
JOIN calendar a ON a.k = j.before + 1 JOIN calendar b ON b.k = j.k - 1""",
    "gap_backfill": f"""
SELECT symbol, bar_date, close FROM gold, bounds
WHERE symbol = hole_symbol AND bar_date >= d_max - {CUT_DAYS + HOLE_DAYS} AND bar_date < d_max - {CUT_DAYS}
  AND bar_date <= (SELECT m FROM mark)""",
    "reload_switch": """
SELECT step, CASE WHEN step = 'second' THEN (SELECT count(*) FROM gold) ELSE (SELECT count(*) FROM existing) END AS n_rows, true AS has_files, 1 AS folders_left
FROM (VALUES ('first'), ('written'), ('failed'), ('second')) AS p(step)""",
    "new_rows_bucketed": f"""
SELECT {BARS} FROM gold g
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.symbol = g.symbol AND e.bar_date = g.bar_date)""",
    "months_from_footers": """
SELECT strftime(bar_date, '%Y-%m') AS bar_month, count(*) AS n, min(bar_date) AS first_date, max(bar_date) AS latest_date FROM existing GROUP BY 1""",
    "load_audit": "\n" + " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, '{load_id}' AS load_id, max(bar_date) AS max_bar_date, count(*) AS "rows", count(*) AS n_new, CAST(0 AS BIGINT) AS n_changed, {_nulls} FROM {rows}"""
        for kind, load_id, rows in (
            ("full_reload", "reload", "gold"), ("incremental", "first", "window_new"), ("incremental", "second", "(SELECT * FROM gold WHERE false)"), ("stream", "batch-0", "gold"),
        )
    ),
    # an old day is late for a symbol that has days after it, and a replay where the symbol still remembers it
    "stream_late_kept": f"""
, newest AS (SELECT symbol, max(bar_date) AS newest, any_value(d_max) AS d_max FROM landed JOIN symbols USING (symbol) GROUP BY symbol),
old AS (SELECT symbol, d_max - {LATE_DAYS} AS bar_date, d_max - {LATE_DAYS} < newest - {LOOKBACK_DAYS} AS late FROM newest)
SELECT symbol, bar_date, close, false AS late FROM landed
UNION ALL SELECT symbol, d_max + 2, CAST(8.5 AS DECIMAL(10,4)), false FROM symbols
UNION ALL SELECT symbol, bar_date, CAST(7.5 AS DECIMAL(10,4)), late FROM old o
WHERE late OR NOT EXISTS (SELECT 1 FROM landed l WHERE l.symbol = o.symbol AND l.bar_date = o.bar_date)""",
    # no symbol's window starts before the first-run window
    "per_key_recovery": f"""
, named AS (SELECT symbol, row_number() OVER (ORDER BY symbol) AS k FROM symbols),
held AS (
  SELECT g.symbol, g.bar_date FROM gold g JOIN named USING (symbol), bounds
  WHERE CASE k WHEN 1 THEN g.bar_date < d_max - {CUT_DAYS + PER_KEY_LATE} WHEN 2 THEN g.bar_date < d_max - {PER_KEY_DEAD}
             WHEN 3 THEN false ELSE g.bar_date < d_max - {CUT_DAYS} END
),
starts AS (
  SELECT symbol, greatest(coalesce(max(h.bar_date) - {LOOKBACK_DAYS}, any_value(d_max) - 100), any_value(d_max) - 100) AS start
  FROM symbols LEFT JOIN held h USING (symbol) GROUP BY symbol
)
SELECT g.symbol, g.bar_date, g.close FROM gold g JOIN starts USING (symbol)
WHERE g.bar_date >= start AND NOT EXISTS (SELECT 1 FROM held h WHERE h.symbol = g.symbol AND h.bar_date = g.bar_date)""",
    "early_exits": """
SELECT 'empty' AS step, 'nothing_landed' AS outcome, CAST(0 AS BIGINT) AS n_new, CAST(NULL AS DATE) AS mark
UNION ALL SELECT 'failed', 'nothing_in_window', 0, NULL
UNION ALL SELECT 'good', 'loaded', (SELECT count(*) FROM gold), (SELECT d_max FROM bounds)
UNION ALL SELECT 'again', 'nothing_new', 0, (SELECT d_max FROM bounds)""",
    "null_counts": """
SELECT CAST(count_if(open IS NULL) AS BIGINT) AS open_nulls, CAST(count_if(high IS NULL) AS BIGINT) AS high_nulls,
       CAST(count_if(low IS NULL) AS BIGINT) AS low_nulls, CAST(count_if(close IS NULL) AS BIGINT) AS close_nulls,
       CAST(count_if(volume IS NULL) AS BIGINT) AS volume_nulls
FROM copies""",
    "duplicate_keys": """
SELECT count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT symbol, bar_date, count(*) AS n FROM copies GROUP BY symbol, bar_date HAVING count(*) > 1)""",
    "dq_report": f"""
SELECT "check", "column", failures, CASE WHEN failures > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (
  {_null_checks}
  UNION ALL
  SELECT 'unique_key', 'symbol,bar_date', CAST(count(*) AS BIGINT)
  FROM (SELECT symbol, bar_date FROM copies GROUP BY symbol, bar_date HAVING count(*) > 1)
  UNION ALL SELECT 'valid_key', 'symbol,bar_date', CAST(0 AS BIGINT)
)""",
    "gold_bars": f"SELECT {TARGET} FROM gold",
    "full_reload": f"SELECT {TARGET} FROM gold",
    "stream_incremental": f"SELECT {TARGET} FROM gold",
    "stream_dedup_late": f"SELECT {BARS} FROM landed",
    "stream_late_rows": f"""
SELECT symbol, bar_date, close, false AS late FROM landed
UNION ALL SELECT symbol, d_max + 2, CAST(8.5 AS DECIMAL(10,4)), false FROM symbols
UNION ALL SELECT symbol, d_max - {LATE_DAYS}, CAST(7.5 AS DECIMAL(10,4)), true FROM symbols s
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.symbol = s.symbol AND l.bar_date = s.d_max - {LATE_DAYS})""",
    "candle_edges": " UNION ALL ".join(
        f"SELECT symbol, bar_date, '{name}' AS variant, {o} AS open, close, "
        f"{pct_sql(o, 'close')} AS daily_return_pct, {candle_sql(o, 'close')} AS candle FROM landed"
        for name, o in (
            ("as_landed", "open"),
            ("null_open", "CAST(NULL AS DECIMAL(10,4))"),
            ("doji", "close"),
            ("zero_open", "CAST(0 AS DECIMAL(10,4))"),
        )
    ),
    "conform_target": f"""
SELECT {TARGET}, CASE WHEN symbol IS NULL OR bar_date IS NULL THEN 'null_key'
                      WHEN length(symbol) > 10 THEN 'symbol_too_long' END AS violation
FROM gold""",
    "load_metrics": """
SELECT count(*) AS "rows", max(bar_date) AS max_bar_date,
       CAST(count_if(open IS NULL) AS BIGINT) AS null_open, CAST(count_if(high IS NULL) AS BIGINT) AS null_high,
       CAST(count_if(low IS NULL) AS BIGINT) AS null_low, CAST(count_if(close IS NULL) AS BIGINT) AS null_close,
       CAST(count_if(volume IS NULL) AS BIGINT) AS null_volume,
       (SELECT count(*) FROM (SELECT 1 FROM copies GROUP BY symbol, bar_date HAVING count(*) > 1)) AS duplicate_keys,
       CAST(count_if(length(symbol) > 10) AS BIGINT) AS violations,
       CAST(count_if(day(bar_date) = 29) AS BIGINT) AS overflows
FROM gold""",
    "fetch_window": f"""
SELECT m AS last_loaded_date, (SELECT d_max FROM bounds) AS as_of, m - {LOOKBACK_DAYS} AS fetch_from FROM mark""",
    "fetch_window_first_run": """
SELECT CAST(NULL AS DATE) AS last_loaded_date, d_max AS as_of, d_max - 100 AS fetch_from FROM bounds""",
    "lookback_window": f"SELECT {BARS} FROM window_rows",
    "window_counts": f"""
SELECT symbol, count(*) AS n_total,
       CAST(count_if(bar_date >= (SELECT m FROM mark) - {LOOKBACK_DAYS}) AS BIGINT) AS n_in_window
FROM gold GROUP BY symbol
HAVING count_if(bar_date >= (SELECT m FROM mark) - {LOOKBACK_DAYS}) > 0""",
    "existing_keys": "SELECT symbol, bar_date FROM existing",
    "new_rows": f"""
SELECT {BARS} FROM gold g
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.symbol = g.symbol AND e.bar_date = g.bar_date)""",
    "new_rows_first_run": f"SELECT {BARS} FROM gold",
    "incremental_summary": """
SELECT (SELECT count(*) FROM window_rows) AS n_incoming, (SELECT count(*) FROM existing) AS n_existing,
       (SELECT count(*) FROM window_rows) - (SELECT count(*) FROM window_new) AS n_matched,
       (SELECT count(*) FROM window_new) AS n_new""",
    "max_loaded_date": "SELECT max(bar_date) AS max_loaded_date FROM window_new",
    "advance_mark": """
SELECT m AS old_mark, (SELECT max(bar_date) FROM window_new) AS batch_max,
       greatest(m, (SELECT max(bar_date) FROM window_new)) AS new_mark FROM mark""",
    "incremental_append": f"SELECT {TARGET} FROM existing UNION ALL SELECT {TARGET} FROM window_new",
    "replay_idempotent": """
SELECT (SELECT count(*) FROM existing) + (SELECT count(*) FROM window_new) AS n_rows,
       (SELECT count(*) FROM existing) + (SELECT count(*) FROM window_new) AS n_keys,
       (SELECT count(*) FROM window_new) AS appended_first, CAST(0 AS BIGINT) AS appended_second""",
    "incremental_noop": """
SELECT 'nothing_new' AS outcome, CAST(0 AS BIGINT) AS n_new,
       greatest(m, (SELECT max(bar_date) FROM window_new)) AS mark_before,
       greatest(m, (SELECT max(bar_date) FROM window_new)) AS mark_after
FROM mark""",
    "partial_load_recovery": """
SELECT symbol, bar_date, bar_date <= (SELECT m FROM mark) AS recovered FROM window_new""",
    "table_scan": "SELECT id, name, department, salary, join_date FROM employees",
    "ordered_scan": "SELECT id, name, department, salary, join_date FROM employees ORDER BY id",
    "fixed_width_report": """
SELECT id, printf('%-5s %-15s %-15s %-10s %s', CAST(id AS VARCHAR), name, department,
                  CAST(salary AS VARCHAR), CAST(join_date AS VARCHAR)) AS line
FROM employees""",
    "labelled_report": "SELECT id, printf('ID: %s | Name: %s', CAST(id AS VARCHAR), name) AS line FROM employees",
    "row_count": """
SELECT 'gold' AS table_name, count(*) AS n_rows FROM gold
UNION ALL SELECT 'employees', count(*) FROM employees
UNION ALL SELECT 'landing', (SELECT count(*) FROM docs) + (SELECT count(*) FROM docs WHERE month(run_date) IN (3, 6, 9, 12))""",
    "rows_per_symbol": "SELECT symbol, count(*) AS n_rows FROM gold GROUP BY symbol",
    "latest_per_symbol": "SELECT symbol, max(bar_date) AS latest_date FROM gold GROUP BY symbol",
    "latest_bars_topk": "SELECT symbol, bar_date, close, candle FROM gold ORDER BY bar_date DESC, symbol LIMIT 10",
    "preview": f"SELECT {TARGET} FROM gold ORDER BY symbol, bar_date LIMIT 5",
}


def oracle_sql() -> dict[str, str]:
    return {name: CTE + body for name, body in SQL.items()}
