"""Schemas of the two feeds and the seven tables, and the registry that ties them together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType

# Column names, order and types of the feeds and tables.
_STAMP = "extract_time timestamp, extract_date date, year integer, month integer, day integer"

_PRICES = (
    "symbol string, current_price double, open double, day_high double, day_low double, "
    "previous_close double, volume double, market_cap {amount}, " + _STAMP
)

_FUNDAMENTALS = (
    "symbol string, shortName string, sector string, industry string, country string, "
    "currency string, fullTimeEmployees {amount}, marketCap {amount}, enterpriseValue {amount}, "
    "totalRevenue {amount}, netIncomeToCommon {amount}, profitMargins double, "
    "revenueGrowth double, ebitda {amount}, enterpriseToRevenue double, "
    "enterpriseToEbitda double, bookValue double, priceToBook double, trailingPE double, "
    "forwardPE double, trailingEps double, forwardEps double, returnOnAssets double, "
    "returnOnEquity double, earningsQuarterlyGrowth double, ipoExpectedDate string, " + _STAMP
)

_CATEGORIES = (
    "marketCapCategory string, employeeCountCategory string, "
    "profitMarginCategory string, revenueGrowthCategory string"
)

_BARS = (
    "symbol string, date date, open double, day_high double, day_low double, "
    "avg_price double, volume double, year integer, month integer"
)

_INDICATORS = (
    "ma_12 double, ma_26 double, ma_60 double, ema_12 double, ema_26 double, ema_60 double, "
    "rsi_12 double, rsi_26 double, rsi_60 double, "
    "bb_upper_12 double, bb_lower_12 double, bb_width_12 double, "
    "bb_upper_26 double, bb_lower_26 double, bb_width_26 double, "
    "bb_upper_60 double, bb_lower_60 double, bb_width_60 double, "
    "macd double, signal double, macd_hist double, obv double"
)

_DQ_LOG = (
    "table_path string, layer string, batch_id string, check_name string, check_type string, "
    "expected_value string, observed_value string, status string, error_message string, "
    "check_timestamp timestamp, year integer, month integer, day integer"
)


def _struct(spec: str) -> StructType:
    struct = StructType()
    for column in spec.split(","):
        name, kind = column.split()
        struct.add(name, kind)
    return struct


PRICE_FEED = _struct(_PRICES.format(amount="double"))
FUNDAMENTALS_FEED = _struct(_FUNDAMENTALS.format(amount="double"))
SILVER_PRICES = _struct(_PRICES.format(amount="long"))
SILVER_FUNDAMENTALS = _struct(_FUNDAMENTALS.format(amount="long") + ", " + _CATEGORIES)
DAILY_BARS = _struct(_BARS)
DAILY_INDICATORS = _struct(_BARS + ", " + _INDICATORS)
DQ_LOG = _struct(_DQ_LOG)

PRICE_KEY = ("symbol", "current_price", "extract_time")
FUNDAMENTALS_KEY = ("symbol", "shortName", "extract_time")
BAR_KEY = ("symbol", "date")
BY_DAY = ("year", "month", "day")
BY_MONTH = ("year", "month")

# Columns of the fundamentals feed that hold whole amounts.
FUNDAMENTALS_AMOUNTS = (
    "fullTimeEmployees",
    "marketCap",
    "enterpriseValue",
    "totalRevenue",
    "netIncomeToCommon",
    "ebitda",
)


# Innermost partition of tables that streams append to: which micro-batch wrote a row.
BATCH_TAG = "batch_tag"

# Kept beside a bar's average, so that bars of later prices can be merged into it.
BAR_PARTIALS = _struct("price_sum double, price_count long")


@dataclass(frozen=True)
class TableSpec:
    """One lakehouse table: where it lives, what it holds, how it is split."""

    layer: str
    name: str
    schema: StructType
    partition_by: tuple[str, ...]
    key: tuple[str, ...] = ()
    tagged: bool = False
    change_feed: bool = False
    versioned: bool = False
    partials: StructType = StructType()

    @property
    def stored_schema(self) -> StructType:
        """Columns of the files and folders, partial sums and the batch tag included."""
        tag = [StructField(BATCH_TAG, StringType())] if self.tagged else []
        return StructType(self.schema.fields + self.partials.fields + tag)

    @property
    def feed_schema(self) -> StructType:
        """Columns of the change feed: the key and the partition of a changed row."""
        return StructType([self.schema[c] for c in dict.fromkeys((*self.key, *self.partition_by))])

    @property
    def folders(self) -> tuple[str, ...]:
        """Partition columns in the order of the folders."""
        return (*self.partition_by, BATCH_TAG) if self.tagged else self.partition_by


TABLES = {
    f"{t.layer}.{t.name}": t
    for t in (
        TableSpec("logging", "dq_log", DQ_LOG, BY_DAY, tagged=True),
        TableSpec("bronze", "fundamentals", FUNDAMENTALS_FEED, BY_DAY, tagged=True),
        TableSpec("bronze", "prices", PRICE_FEED, BY_DAY, tagged=True),
        TableSpec("silver", "fundamentals", SILVER_FUNDAMENTALS, BY_DAY, FUNDAMENTALS_KEY, tagged=True),
        TableSpec("silver", "prices", SILVER_PRICES, BY_DAY, PRICE_KEY, tagged=True),
        TableSpec("silver", "daily_price_aggregates", DAILY_BARS, BY_MONTH, BAR_KEY, change_feed=True, versioned=True, partials=BAR_PARTIALS),
        TableSpec("gold", "daily_price_indicators", DAILY_INDICATORS, BY_MONTH, BAR_KEY, versioned=True),
    )
}
