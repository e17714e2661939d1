"""Market-shaped views over the test tables, as SQL that Spark and the oracle both run.

``{name}`` stands for a table; Spark fills in a DataFrame, the oracle the table's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FETCHED = """
SELECT event_type AS symbol, value AS "lastPrice", value * 0.99 AS open, value * 1.02 AS "dayHigh",
  value * 0.97 AS "dayLow", value AS "previousClose", CAST(event_id % 1000 AS DOUBLE) AS volume,
  value * 1e9 AS "marketCap", CAST(ts AS TIMESTAMP) AS taken_at
FROM {events}
"""

TICKS = """
SELECT event_type AS symbol, value AS current_price, value * 0.99 AS open, value * 1.02 AS day_high,
  value * 0.97 AS day_low, value AS previous_close, CAST(event_id % 1000 AS DOUBLE) AS volume,
  value * 1e9 AS market_cap, CAST(ts AS TIMESTAMP) AS extract_time, CAST(ts AS DATE) AS extract_date,
  CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day
FROM {events}
"""

# Ticks as they come in: free ones lack a price, the last minutes of each hour come twice.
DELIVERIES = """
SELECT symbol, nullif(current_price, 0) AS current_price, open, day_high, day_low, previous_close,
  volume, market_cap, extract_time, extract_date, year, month, day
FROM {ticks}
UNION ALL
SELECT symbol, nullif(current_price, 0) AS current_price, open, day_high, day_low, previous_close,
  volume, market_cap, extract_time, extract_date, year, month, day
FROM {ticks} WHERE minute(extract_time) >= 50
"""

BARS = """
SELECT l_returnflag || l_linestatus AS symbol, CAST(l_shipdate AS DATE) AS date,
  max(l_extendedprice / l_quantity) AS open, max(l_extendedprice / l_quantity) AS day_high,
  min(l_extendedprice / l_quantity) AS day_low, avg(l_extendedprice / l_quantity) AS avg_price,
  max(l_quantity) AS volume, CAST(year(CAST(l_shipdate AS DATE)) AS INT) AS year,
  CAST(month(CAST(l_shipdate AS DATE)) AS INT) AS month
FROM {lineitem}
GROUP BY l_returnflag || l_linestatus, CAST(l_shipdate AS DATE)
"""

COMPANIES = """
SELECT concat('C', c_custkey) AS symbol, c_name AS "shortName", c_mktsegment AS sector,
  CAST(c_custkey % 20 * 1000 AS DOUBLE) AS "fullTimeEmployees", c_acctbal * 5e7 AS "marketCap",
  c_acctbal / 20000 AS "profitMargins", c_acctbal / 40000 AS "revenueGrowth"
FROM {customer}
"""

# A snapshot of a customer at the start of each month, once per order; several orders of a month
# give copies, debtors lack a name.
FUNDAMENTALS = """
SELECT concat('C', c_custkey) AS symbol, CASE WHEN c_acctbal >= 0 THEN c_name END AS "shortName",
  c_mktsegment AS sector, CAST(NULL AS STRING) AS industry, n_name AS country, 'USD' AS currency,
  CAST(c_custkey % 20 * 1000 AS DOUBLE) AS "fullTimeEmployees", c_acctbal * 5e7 AS "marketCap",
  c_acctbal * 6e7 AS "enterpriseValue", c_acctbal * 1e6 AS "totalRevenue",
  c_acctbal * 1e5 AS "netIncomeToCommon", c_acctbal / 20000 AS "profitMargins",
  c_acctbal / 40000 AS "revenueGrowth", c_acctbal * 2e5 AS ebitda,
  c_acctbal / 500 AS "enterpriseToRevenue", c_acctbal / 250 AS "enterpriseToEbitda",
  c_acctbal / 100 AS "bookValue", c_acctbal / 1000 AS "priceToBook", c_acctbal / 300 AS "trailingPE",
  c_acctbal / 400 AS "forwardPE", c_acctbal / 800 AS "trailingEps", c_acctbal / 700 AS "forwardEps",
  c_acctbal / 30000 AS "returnOnAssets", c_acctbal / 15000 AS "returnOnEquity",
  c_acctbal / 60000 AS "earningsQuarterlyGrowth", CAST(NULL AS STRING) AS "ipoExpectedDate",
  CAST(taken AS TIMESTAMP) AS extract_time, CAST(taken AS DATE) AS extract_date,
  CAST(year(taken) AS INT) AS year, CAST(month(taken) AS INT) AS month, CAST(day(taken) AS INT) AS day
FROM (SELECT o_custkey, date_trunc('month', o_orderdate) AS taken FROM {orders}) AS snapshots
JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

DOC_LABELS = """
SELECT d.doc_id, d.lang, l.quality, l.toxic
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

_INPUTS = {
    FETCHED: ("events",),
    TICKS: ("events",),
    BARS: ("lineitem",),
    COMPANIES: ("customer",),
    FUNDAMENTALS: ("orders", "customer", "nation"),
    DOC_LABELS: ("documents", "labels"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A view as a DataFrame."""
    if text == DELIVERIES:
        return spark.sql(DELIVERIES, ticks=view(spark, sf_dir, TICKS))
    inputs = {name: table(spark, sf_dir, name) for name in _INPUTS[text]}
    return spark.sql(text.replace('"', "`"), **inputs)


def oracle_view(text: str) -> str:
    """The same view as a subquery for the oracle."""
    if text == DELIVERIES:
        return DELIVERIES.format(ticks=f"({oracle_view(TICKS)}) AS ticks").strip()
    return text.format(**{name: name for name in _INPUTS[text]}).strip()


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column, for comparison with another engine's sums.

    Half is rounded up by plain arithmetic, since the engines' own ``round`` differ on ties.
    """
    scale = float(10**digits)
    return df.select(
        *[
            (F.floor(F.col(c) * scale + 0.5) / scale).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def oracle_round(column: str, digits: int = 6) -> str:
    """The same rounding as SQL."""
    return f"floor({column} * 1e{digits} + 0.5) / 1e{digits}"
