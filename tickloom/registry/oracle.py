"""The same results as plain SQL, written independently of the library."""

from __future__ import annotations

from tickloom.registry import views
from tickloom.registry.views import oracle_round, oracle_view
from tickloom.schemas import BY_DAY, DAILY_INDICATORS, FUNDAMENTALS_FEED, PRICE_FEED

TICKS = f"({oracle_view(views.TICKS)})"
FETCHED = f"({oracle_view(views.FETCHED)})"
DELIVERIES = f"({oracle_view(views.DELIVERIES)})"
BARS = f"({oracle_view(views.BARS)})"
COMPANIES = f"({oracle_view(views.COMPANIES)})"
FUNDAMENTALS = f"({oracle_view(views.FUNDAMENTALS)})"
DOC_LABELS = f"({oracle_view(views.DOC_LABELS)})"

AS_OF = "DATE '1998-06-15'"
WINDOWS = (12, 26, 60)


def _columns(schema, digits: int = 6, skip: tuple = ()) -> str:
    """Select list of a schema with rounded DOUBLE columns."""
    parts = []
    for field in schema.fields:
        if field.name in skip:
            continue
        kind = field.dataType.simpleString()
        name = f'"{field.name}"'
        parts.append(f"{oracle_round(name, digits)} AS {name}" if kind == "double" else name)
    return ", ".join(parts)


def _whole(column: str) -> str:
    return f'CAST(trunc("{column}") AS BIGINT) AS "{column}"'


def _case(column: str, steps: list[tuple[str, str]], rest: str) -> str:
    whens = " ".join(f"WHEN \"{column}\" >= {low} THEN '{label}'" for low, label in steps)
    return f"CASE {whens} ELSE '{rest}' END"


CATEGORIES = {
    "marketCapCategory": _case(
        "marketCap",
        [("200000000000", "Mega Cap"), ("10000000000", "Large Cap"), ("2000000000", "Mid Cap")],
        "Small Cap",
    ),
    "employeeCountCategory": _case(
        "fullTimeEmployees", [("10000", "Large Workforce"), ("1000", "Medium Workforce")], "Small Workforce"
    ),
    "profitMarginCategory": _case(
        "profitMargins", [("0.2", "High Margin"), ("0.05", "Moderate Margin")], "Low Margin"
    ),
    "revenueGrowthCategory": _case(
        "revenueGrowth", [("0.15", "High Growth"), ("0.05", "Moderate Growth")], "Low or Negative Growth"
    ),
}


def _category(column: str, name: str) -> str:
    return f'SELECT symbol, "{column}", {CATEGORIES[name]} AS "{name}" FROM {COMPANIES}'


_AMOUNTS = ("fullTimeEmployees", "marketCap", "enterpriseValue", "totalRevenue", "netIncomeToCommon", "ebitda")

CLEAN_FUNDAMENTALS = f"""
SELECT DISTINCT {", ".join(
    f'"{f.name}"' if f.name in _AMOUNTS or f.dataType.simpleString() != "double"
    else f'{oracle_round(chr(34) + f.name + chr(34))} AS "{f.name}"' for f in FUNDAMENTALS_FEED.fields)},
  {", ".join(f'{rule} AS "{name}"' for name, rule in CATEGORIES.items())}
FROM (SELECT * REPLACE ({", ".join(_whole(c) for c in _AMOUNTS)}) FROM {FUNDAMENTALS})
WHERE symbol IS NOT NULL AND "shortName" IS NOT NULL AND extract_time IS NOT NULL
"""

CLEAN_PRICES = f"""
SELECT {_columns(PRICE_FEED, skip=("market_cap",))}, CAST(trunc(market_cap) AS BIGINT) AS market_cap
FROM (SELECT DISTINCT * FROM {DELIVERIES})
WHERE symbol IS NOT NULL AND current_price IS NOT NULL AND extract_time IS NOT NULL
"""

DAILY = f"""
SELECT symbol, CAST(extract_time AS DATE) AS date, max(open) AS open, max(day_high) AS day_high,
  min(day_low) AS day_low, avg(current_price) AS avg_price, max(volume) AS volume, year, month
FROM {TICKS} GROUP BY symbol, CAST(extract_time AS DATE), year, month
"""

_BAR_VALUES = ["open", "day_high", "day_low", "avg_price", "volume"]
_BAR_LIST = "symbol, date, year, month, " + ", ".join(f"{oracle_round(c, 8)} AS {c}" for c in _BAR_VALUES)
DAILY_ROUNDED = f"SELECT {_BAR_LIST} FROM ({DAILY})"

# Every bar with each bar of the 90 days up to it, ranked newest first, and the price step from
# one rank to the next.
_HISTORY = f"""
bars AS MATERIALIZED {BARS},
ranked AS (
  SELECT b.symbol, b.date, h.avg_price AS p, h.volume AS v,
    row_number() OVER (PARTITION BY b.symbol, b.date ORDER BY h.date DESC) AS rn
  FROM bars b JOIN bars h ON h.symbol = b.symbol AND h.date BETWEEN b.date - 90 AND b.date
),
hist AS MATERIALIZED (
  SELECT *, p - lag(p) OVER (PARTITION BY symbol, date ORDER BY rn) AS older_minus_newer,
    lag(v) OVER (PARTITION BY symbol, date ORDER BY rn) AS newer_v
  FROM ranked
)
"""


def _lookback(*expressions: str) -> str:
    return f"SELECT symbol, date, {', '.join(expressions)} FROM hist GROUP BY symbol, date"


def _ma(n: int) -> str:
    return f"avg(p) FILTER (WHERE rn <= {n}) AS ma_{n}"


def _rsi(n: int, gain: str = "older_minus_newer") -> str:
    up = f"coalesce(sum({gain}) FILTER (WHERE rn <= {n} AND {gain} > 0), 0)"
    down = f"coalesce(-sum({gain}) FILTER (WHERE rn <= {n} AND {gain} < 0), 0)"
    return (
        f"CASE WHEN {down} = 0 THEN 100.0 "
        f"ELSE 100 - 100 / (1 + ({up} / {n}.0) / ({down} / {n}.0)) END AS rsi_{n}"
    )


def _bands(n: int) -> str:
    mean, dev = f"avg(p) FILTER (WHERE rn <= {n})", f"stddev_samp(p) FILTER (WHERE rn <= {n})"
    enough = f"CASE WHEN max(rn) >= {n} THEN"
    return (
        f"{enough} {mean} + 2 * {dev} END AS bb_upper_{n}, "
        f"{enough} {mean} - 2 * {dev} END AS bb_lower_{n}, "
        f"{enough} 4 * {dev} END AS bb_width_{n}"
    )


_OBV_OLDEST = (
    "coalesce(sum(CASE WHEN older_minus_newer < 0 THEN newer_v "
    "WHEN older_minus_newer > 0 THEN -newer_v ELSE 0 END), 0.0) AS obv"
)
# Running sum of the ranked history at rank 1: only the newest row, which has no difference.
_OBV_NEWEST = (
    "CAST(sum(CASE WHEN rn > 1 THEN NULL WHEN older_minus_newer > 0 THEN v "
    "WHEN older_minus_newer < 0 THEN -v ELSE 0 END) AS DOUBLE) AS obv"
)


def _rounded(columns: list[str], digits: int = 4) -> str:
    return ", ".join(f"{oracle_round(c, digits)} AS {c}" for c in columns)


def _back(columns: list[str], *expressions: str) -> str:
    return f"WITH {_HISTORY} SELECT symbol, date, {_rounded(columns)} FROM ({_lookback(*expressions)})"


# The recurrences step by step over the numbered rows of each symbol.
_STEPS = """
seeds AS MATERIALIZED (
  SELECT b.symbol, b.date, b.avg_price AS p, m.ma_12, m.ma_26, m.ma_60,
    row_number() OVER (PARTITION BY b.symbol ORDER BY b.date) AS n,
    b.date - lag(b.date) OVER (PARTITION BY b.symbol ORDER BY b.date) AS gap
  FROM bars b JOIN back m ON m.symbol = b.symbol AND m.date = b.date
),
steps AS (
  SELECT symbol, date, n, ma_12 AS ema_12, ma_26 AS ema_26, ma_60 AS ema_60,
    ma_12 - ma_26 AS macd, ma_12 - ma_26 AS signal
  FROM seeds WHERE n = 1
  UNION ALL
  SELECT symbol, date, n, ema_12, ema_26, ema_60, ema_12 - ema_26,
    CASE WHEN gap > 5 THEN ema_12 - ema_26 ELSE signal * 0.8e0 + (ema_12 - ema_26) * 0.2e0 END
  FROM (
    SELECT s.symbol, s.date, s.n, s.gap, t.signal,
      CASE WHEN s.gap > 5 THEN s.ma_12 ELSE t.ema_12 * 11e0 / 13e0 + s.p * 2e0 / 13e0 END AS ema_12,
      CASE WHEN s.gap > 5 THEN s.ma_26 ELSE t.ema_26 * 25e0 / 27e0 + s.p * 2e0 / 27e0 END AS ema_26,
      CASE WHEN s.gap > 5 THEN s.ma_60 ELSE t.ema_60 * 59e0 / 61e0 + s.p * 2e0 / 61e0 END AS ema_60
    FROM steps t JOIN seeds s ON s.symbol = t.symbol AND s.n = t.n + 1
  )
)
"""


def _recursive(columns: list[str]) -> str:
    back = _lookback(*[_ma(n) for n in WINDOWS])
    return (
        f"WITH RECURSIVE {_HISTORY}, back AS MATERIALIZED ({back}), {_STEPS} "
        f"SELECT symbol, date, {_rounded(columns)} FROM (SELECT *, macd - signal AS macd_hist FROM steps)"
    )


_ALL_BACK = _lookback(
    *[_ma(n) for n in WINDOWS], *[_rsi(n) for n in WINDOWS], *[_bands(n) for n in WINDOWS], _OBV_NEWEST
)
_INDICATORS = f"""
WITH RECURSIVE {_HISTORY}, back AS MATERIALIZED ({_ALL_BACK}), {_STEPS},
ind AS (
  SELECT b.*, k.* EXCLUDE (symbol, date), s.ema_12, s.ema_26, s.ema_60, s.macd, s.signal,
    s.macd - s.signal AS macd_hist
  FROM bars b
  JOIN back k ON k.symbol = b.symbol AND k.date = b.date
  JOIN steps s ON s.symbol = b.symbol AND s.date = b.date
)
"""
DAILY_INDICATORS_SQL = f"{_INDICATORS} SELECT {_columns(DAILY_INDICATORS, 4)} FROM ind"


# Checks


def _log(
    path: str,
    name: str,
    expected: str,
    observed: str,
    failed: str,
    message: str,
    source: str,
    kind: str = "validation",
    batch: str = "'b1'",
) -> str:
    return f"""
SELECT '{path}' AS table_path, 'Silver' AS layer, {batch} AS batch_id, '{name}' AS check_name,
  '{kind}' AS check_type, {expected} AS expected_value, {observed} AS observed_value,
  CASE WHEN {failed} THEN 'FAIL' ELSE 'PASS' END AS status,
  CASE WHEN {failed} THEN {message} ELSE '' END AS error_message,
  TIMESTAMP '2024-01-15 10:00:00' AS check_timestamp, 2024 AS year, 1 AS month, 15 AS day
FROM ({source})
"""


def _counted(path: str, name: str, expected: str, unit: str, where: str, n: str) -> str:
    observed = f"n || ' {unit}'"
    where, expected = where.replace("'", "''"), expected.replace("'", "''")
    return _log(
        path, name, f"'{expected}'", observed, "n > 0", f"{observed} || '{where}'", f"SELECT ({n}) AS n"
    )


def _nulls(path: str, column: str, source: str) -> str:
    n = f"SELECT count(*) FROM {source} WHERE {column} IS NULL"
    return _counted(path, f"null_check_{column}", "No nulls", "nulls", f" in column {column}", n)


def _negatives(path: str, column: str, source: str) -> str:
    n = f"SELECT count(*) FROM {source} WHERE {column} < 0"
    return _counted(
        path, f"non_negative_check_{column}", "Values >= 0", "invalid values", f" in column {column} (< 0)", n
    )


def _surplus(columns: list[str], source: str) -> str:
    listed = ", ".join(columns)
    return f"SELECT (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {source}))"


def _repeated(columns: list[str], source: str) -> str:
    listed = ", ".join(columns)
    return f"SELECT count(*) FROM (SELECT {listed} FROM {source} GROUP BY {listed} HAVING count(*) > 1)"


def _uniqueness(path: str, columns: list[str], n: str) -> str:
    return _counted(
        path,
        f"multi_column_uniqueness_{'_'.join(columns)}",
        f"Unique combination of {columns}",
        "duplicate rows",
        f" for columns {columns}",
        n,
    )


def _row_count(path: str, source: str, expected: str) -> str:
    return _log(
        path,
        "row_count_exact_check",
        "'Exactly ' || e || ' rows'",
        "n || ' rows'",
        "n <> e",
        "'Row count ' || n || ' rows does not match expected ' || e",
        f"SELECT (SELECT count(*) FROM {source}) AS n, ({expected}) AS e",
    )


_HOURLY = "(SELECT date_trunc('hour', ts) AS extract_time, event_type AS symbol FROM events)"


def _expected(source: str) -> str:
    return (
        "(SELECT count(DISTINCT event_type) FROM events) * "
        f"(SELECT count(*) FROM (SELECT DISTINCT extract_time FROM {source}))"
    )


_LINE_KEY = ["l_orderkey", "l_linenumber"]
_PRICE_KEY = ["symbol", "current_price", "extract_time"]

_SHIFTED = """(SELECT event_id, event_type, CASE WHEN event_id % 1000 % 3 = 0 THEN CAST(ts AS TIMESTAMP) - INTERVAL 31 DAY
    ELSE CAST(ts AS TIMESTAMP) END AS ts FROM events)"""
_DUPLICATE_FILES = _log(
    "bronze.prices",
    "duplicate_file_check",
    "'No duplicate (symbol, extract_time-hour) in Bronze table'",
    "n || ' duplicates'",
    "n > 0",
    "n || ' duplicate (symbol, extract_time-hour) records found in Bronze table'",
    """SELECT count(*) AS n FROM {shifted} i JOIN {shifted} b ON i.event_type = b.event_type
       AND date_trunc('hour', i.ts) = date_trunc('hour', b.ts)
       WHERE minute(i.ts) >= 30 AND minute(b.ts) < 30 AND b.event_id % 1000 % 5 <> 0 AND {scope}""",
    kind="quality",
)

_MESSAGES = " UNION ALL ".join(
    [
        _nulls("doc_labels", "quality", DOC_LABELS),
        _negatives("doc_labels", "toxic", DOC_LABELS),
        _row_count("doc_labels", DOC_LABELS, "0"),
        _uniqueness("doc_labels", ["lang", "quality"], _surplus(["lang", "quality"], DOC_LABELS)),
    ]
)

_KEPT = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

_NEWEST_OF_HOUR = f"""(SELECT symbol, date_trunc('hour', extract_time) AS hour_start, current_price, volume, year, month FROM {TICKS}
    QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('hour', extract_time)
      ORDER BY extract_time DESC, current_price DESC, volume DESC) = 1)"""

ORACLE: dict[str, str] = {
    "scan_table": "SELECT * FROM orders",
    "sql_select_all": f"SELECT {_columns(PRICE_FEED)} FROM {TICKS}",
    "csv_untyped_read": f"""SELECT {_columns(PRICE_FEED, skip=("extract_time", "extract_date", *BY_DAY))},
        strftime(extract_time, '%Y-%m-%dT%H:%M:%S.%f') AS extract_time,
        CAST(extract_date AS VARCHAR) AS extract_date, CAST(year AS VARCHAR) AS year,
        CAST(month AS VARCHAR) AS month, CAST(day AS VARCHAR) AS day FROM {TICKS}""",
    "symbol_list": f"""SELECT symbol, 'lines' AS reader FROM {COMPANIES}
        UNION ALL SELECT sector, 'lines' FROM {COMPANIES}
        UNION ALL SELECT symbol || ' ', 'column' FROM {COMPANIES}
        UNION ALL SELECT sector, 'column' FROM {COMPANIES}""",
    "csv_roundtrip": f"SELECT {_columns(PRICE_FEED)} FROM {TICKS}",
    "preview_limit": f"""SELECT {_columns(PRICE_FEED)} FROM {TICKS}
        ORDER BY extract_time, symbol, current_price, volume LIMIT 100""",
    "file_inventory": f"""SELECT 'feed_year=' || year || '/feed_month=' || month AS folder, count(*) AS rows,
        true AS all_listed, true AS lengths_agree FROM {BARS} GROUP BY ALL""",
    "ddl_catalog": f"""SELECT 'bronze.prices' AS table_name, year, month, count(*) AS n FROM {TICKS} GROUP BY ALL
        UNION ALL SELECT 'silver.daily_price_aggregates', year, month, count(*) FROM {BARS} GROUP BY ALL""",
    "filter_not_null": f"SELECT * FROM {DOC_LABELS} WHERE quality IS NOT NULL AND toxic IS NOT NULL",
    "cast_ints": """SELECT c_custkey, CAST(trunc(c_acctbal * 1e9) AS BIGINT) AS amount,
        CAST(trunc(c_acctbal) AS BIGINT) AS amount_text, c_custkey AS whole_text,
        TRY_CAST(c_name AS BIGINT) AS no_amount FROM customer""",
    "bucket_market_cap": _category("marketCap", "marketCapCategory"),
    "bucket_employees": _category("fullTimeEmployees", "employeeCountCategory"),
    "bucket_margin": _category("profitMargins", "profitMarginCategory"),
    "bucket_growth": _category("revenueGrowth", "revenueGrowthCategory"),
    "add_prev_prefix": f"""SELECT symbol, date AS prev_date, year AS prev_year, month AS prev_month,
        {", ".join(f"{oracle_round(c)} AS prev_{c}" for c in _BAR_VALUES)} FROM {BARS}""",
    "order_columns": f"SELECT {_columns(FUNDAMENTALS_FEED)}, country AS unlisted FROM {FUNDAMENTALS}",
    "normalize_snapshot": f"SELECT {_columns(PRICE_FEED, skip=('extract_time', 'extract_date', *BY_DAY))} FROM {TICKS}",
    "stamp_partitions": """SELECT o_orderkey, t AS extract_time, CAST(t AS DATE) AS extract_date,
        CAST(year(t) AS INT) AS year, CAST(month(t) AS INT) AS month, CAST(day(t) AS INT) AS day
        FROM (SELECT o_orderkey, o_orderdate + INTERVAL 2 DAY AS t FROM orders)""",
    "drop_duplicates": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {_KEPT}) AS rn FROM lineitem) WHERE rn = 1""",
    "clean_prices": CLEAN_PRICES,
    "clean_fundamentals": CLEAN_FUNDAMENTALS,
    "extract_hour": f"""SELECT symbol, extract_time,
        concat_ws('-', year, month, day, hour(extract_time)) AS extract_hour FROM {TICKS}""",
    "month_pairs": f"""SELECT date, CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month
        FROM (SELECT date, unnest(generate_series(date_trunc('month', date - 90),
        date_trunc('month', date), INTERVAL 1 MONTH)) AS m FROM (SELECT DISTINCT date FROM {BARS}))""",
    "history_slice": f"""SELECT symbol, date, {_rounded(_BAR_VALUES, 6)},
        year, month, CAST(row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS INT) AS rn
        FROM {BARS} WHERE date BETWEEN {AS_OF} - 90 AND {AS_OF}""",
    "latest_row": f"""SELECT symbol, date, {_rounded(_BAR_VALUES, 6)},
        year, month FROM {BARS} WHERE date >= {AS_OF} - 5 AND date < {AS_OF}
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1""",
    "history_slice_hourly": f"""SELECT symbol, hour_start, {oracle_round("current_price")} AS current_price, volume, year, month,
        CAST(row_number() OVER (PARTITION BY symbol ORDER BY hour_start DESC) AS INT) AS rn FROM {_NEWEST_OF_HOUR}
        WHERE hour_start >= TIMESTAMP '2024-01-08' AND hour_start < TIMESTAMP '2024-01-16'""",
    "latest_row_hourly": f"""SELECT symbol, hour_start, {oracle_round("current_price")} AS current_price, volume, year, month
        FROM {_NEWEST_OF_HOUR} WHERE hour_start >= TIMESTAMP '2024-01-12' AND hour_start < TIMESTAMP '2024-01-15'
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY hour_start DESC) = 1""",
    "price_diff": f"""SELECT symbol, date, {oracle_round("(avg_price - lead(avg_price) OVER (PARTITION BY symbol ORDER BY date))")} AS price_diff FROM {BARS}""",
    "obv_running": f"""SELECT symbol, date, obv_change,
        sum(obv_change) OVER (PARTITION BY symbol ORDER BY date DESC) AS obv
        FROM (SELECT symbol, date, CASE WHEN avg_price > newer THEN volume WHEN avg_price < newer THEN -volume
          ELSE 0 END AS obv_change
        FROM (SELECT *, lead(avg_price) OVER (PARTITION BY symbol ORDER BY date) AS newer FROM {BARS}))""",
    "join_prev_state": f"""WITH b AS {BARS} SELECT b.symbol, b.date, {oracle_round("b.avg_price")} AS avg_price,
        p.date AS prev_date, {oracle_round("p.avg_price")} AS prev_avg_price
        FROM b LEFT JOIN (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1) p
        ON p.symbol = b.symbol""",
    "outer_join_fold": """SELECT 'C' || o_custkey AS symbol, max(o_totalprice) FILTER (WHERE o_orderstatus = 'F')
        AS best_f, max(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS best_o,
        max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS best_p
        FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY o_custkey""",
    "union_by_name": f"SELECT {_BAR_LIST} FROM {BARS} UNION ALL BY NAME {DAILY_ROUNDED}",
    "distinct_dates": f"SELECT DISTINCT date FROM {BARS}",
    "max_partition": f"SELECT max(year) AS year, max(month) AS month FROM {BARS}",
    "daily_bars": DAILY_ROUNDED,
    "sma": _back([f"ma_{n}" for n in WINDOWS], *[_ma(n) for n in WINDOWS]),
    "ema": _recursive([f"ema_{n}" for n in WINDOWS]),
    "rsi_newest_first": _back([f"rsi_{n}" for n in WINDOWS], *[_rsi(n) for n in WINDOWS]),
    "rsi_oldest_first": _back(
        [f"rsi_{n}" for n in WINDOWS], *[_rsi(n, "(-older_minus_newer)") for n in WINDOWS]
    ),
    "macd": _recursive(["macd", "signal", "macd_hist"]),
    "bollinger": _back(
        [f"bb_{edge}_{n}" for n in WINDOWS for edge in ("upper", "lower", "width")],
        *[_bands(n) for n in WINDOWS],
    ),
    "obv_newest_first": _back(["obv"], _OBV_NEWEST),
    "obv_oldest_first": _back(["obv"], _OBV_OLDEST),
    "daily_indicators": DAILY_INDICATORS_SQL,
    "dq_null": " UNION ALL ".join(_nulls("doc_labels", c, DOC_LABELS) for c in ("doc_id", "quality", "toxic")),
    "dq_non_negative": " UNION ALL ".join(_negatives("customer", c, "customer") for c in ("c_acctbal", "c_custkey")),
    "dq_row_count": _row_count("ticks", _HOURLY, _expected(_HOURLY)),
    "dq_unique_total": _uniqueness("lineitem", _LINE_KEY, _surplus(_LINE_KEY, "lineitem")),
    "dq_unique_groups": _uniqueness("lineitem", _LINE_KEY, _repeated(_LINE_KEY, "lineitem")),
    "dq_duplicate_files_month": _DUPLICATE_FILES.format(shifted=_SHIFTED, scope="year(b.ts) = 2024 AND month(b.ts) = 1"),
    "dq_duplicate_files_days": _DUPLICATE_FILES.format(
        shifted=_SHIFTED,
        scope=f"CAST(b.ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM {_SHIFTED} WHERE minute(ts) >= 30)",
    ),
    "dq_gate_prices": " UNION ALL ".join(
        [
            _negatives("silver.prices", "current_price", DELIVERIES),
            _row_count("silver.prices", DELIVERIES, _expected(DELIVERIES)),
            _uniqueness("silver.prices", _PRICE_KEY, _surplus(_PRICE_KEY, DELIVERIES)),
            *[_nulls("silver.prices", c, DELIVERIES) for c in _PRICE_KEY],
        ]
    ),
    "dq_file_arrival": """SELECT *, 'file_arrival_check' AS check_name, 'ingestion' AS check_type, 'Bronze' AS layer FROM (VALUES
        ('found', 'PASS', 'Found', ''), ('too_old', 'FAIL', 'a time', 'Latest file'),
        ('missing', 'FAIL', 'Missing', 'No files found')) AS cases("case", status, observed, said)
        WHERE EXISTS (FROM events)""",
    "dq_log_append": " UNION ALL ".join(
        [
            *[_nulls("doc_labels", c, DOC_LABELS) for c in ("doc_id", "quality", "toxic")],
            *[_negatives("customer", c, "customer") for c in ("c_acctbal", "c_custkey")],
        ]
    ),
    "dq_log_retry": " UNION ALL ".join(
        _nulls("doc_labels", c, f"(SELECT * FROM {DOC_LABELS} WHERE quality IS NOT NULL AND toxic IS NOT NULL)")
        for c in ("doc_id", "quality", "toxic")
    ),
    "dq_message_format": f"SELECT check_name, expected_value, observed_value, status, error_message FROM ({_MESSAGES})",
    "expected_rows": f"SELECT {_expected(_HOURLY)} AS expected_rows",
    "upsert_daily_bars": f"""WITH old AS (
          SELECT symbol, CAST(extract_time AS DATE) AS date, max(open) AS open, max(day_high) AS day_high,
            min(day_low) AS day_low, avg(current_price) AS avg_price, max(volume) AS volume, year, month
          FROM {TICKS} WHERE extract_time < TIMESTAMP '2024-01-20 12:00:00'
          GROUP BY symbol, CAST(extract_time AS DATE), year, month),
        changes AS (SELECT * FROM ({DAILY}) WHERE date >= DATE '2024-01-13')
        SELECT {_BAR_LIST} FROM (
          SELECT * FROM old WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM changes)
          UNION ALL BY NAME SELECT * FROM changes)""",
    "upsert_indicators": f"""{_INDICATORS},
        old AS (SELECT * REPLACE (ma_12 + 1000 AS ma_12) FROM ind WHERE date < DATE '2000-01-01'),
        changes AS (SELECT * FROM ind WHERE date >= DATE '1998-01-01')
        SELECT {_columns(DAILY_INDICATORS, 4)} FROM (
          SELECT o.* FROM old o ANTI JOIN changes c ON c.symbol = o.symbol AND c.date = o.date
          UNION ALL BY NAME SELECT * FROM changes)""",
    "stream_prices_ingest": f"SELECT {_columns(PRICE_FEED)} FROM {TICKS}",
    "stream_fundamentals_ingest": f"SELECT {_columns(FUNDAMENTALS_FEED)} FROM {FUNDAMENTALS}",
    "stream_misfits": f"""SELECT CASE WHEN extract_time >= TIMESTAMP '2024-01-16 12:00:00' THEN 'header'
    WHEN volume % 50 = 0 THEN 'row' ELSE 'kept' END AS fate, symbol, day, count(*) AS n
  FROM {TICKS} GROUP BY ALL""",
    "stream_silver_prices": CLEAN_PRICES,
    "stream_fundamentals_dedup": CLEAN_FUNDAMENTALS,
    "stream_daily_bars": DAILY_ROUNDED,
    "stream_daily_bars_windowed": DAILY_ROUNDED,
    "stream_replay": DAILY_ROUNDED,
    "stream_indicators": DAILY_INDICATORS_SQL,
}
