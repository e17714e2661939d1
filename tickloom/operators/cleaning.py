"""Row cleaning, column shaping and de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import buckets
from tickloom.functions.casts import whole_number
from tickloom.schemas import FUNDAMENTALS_AMOUNTS, FUNDAMENTALS_FEED, FUNDAMENTALS_KEY, PRICE_FEED, PRICE_KEY

# Field names of a fetched price snapshot and the columns they fill.
SNAPSHOT_FIELDS = {
    "symbol": "symbol",
    "lastPrice": "current_price",
    "open": "open",
    "dayHigh": "day_high",
    "dayLow": "day_low",
    "previousClose": "previous_close",
    "volume": "volume",
    "marketCap": "market_cap",
}

STAMP_COLUMNS = ("extract_time", "extract_date", "year", "month", "day")


def filter_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL; NaN counts as a value."""
    return df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in columns) or "true")


def cast_ints(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: whole_number(c) for c in columns})


def add_categories(df: DataFrame) -> DataFrame:
    """The four category columns of the fundamentals table."""
    return df.withColumns(
        {
            "marketCapCategory": buckets.market_cap_category(),
            "employeeCountCategory": buckets.employee_category(),
            "profitMarginCategory": buckets.margin_category(),
            "revenueGrowthCategory": buckets.growth_category(),
        }
    )


def add_prev_prefix(df: DataFrame, keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """Mark every column outside ``keep`` as state of the previous row."""
    return df.select(*[c if c in keep else F.col(c).alias(f"prev_{c}") for c in df.columns])


def order_columns(df: DataFrame, preferred: Sequence[str] = tuple(FUNDAMENTALS_FEED.names)) -> DataFrame:
    """Known columns first and in their fixed order, unknown ones after them."""
    known = [c for c in preferred if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def normalize_snapshot(df: DataFrame, fields: Mapping[str, str] = SNAPSHOT_FIELDS) -> DataFrame:
    """Map fetched field names to column names; a field that was not delivered is NULL."""
    return df.select(
        *[
            (F.col(f) if f in df.columns else F.lit(None).cast(PRICE_FEED[c].dataType)).alias(c)
            for f, c in fields.items()
        ]
    )


def stamp_partitions(df: DataFrame, taken_at: Column, shift_days: int = 0) -> DataFrame:
    """Add the snapshot time and the date columns derived from it."""
    moment = taken_at.cast("timestamp") + F.make_dt_interval(days=F.lit(shift_days))
    stamped = df.withColumn("extract_time", moment)
    return stamped.withColumns(
        {
            "extract_date": F.to_date("extract_time"),
            "year": F.year("extract_time"),
            "month": F.month("extract_time"),
            "day": F.dayofmonth("extract_time"),
        }
    )


def drop_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest of the others, column by column, NULL first.

    The survivor is the same on every run. It is an aggregate, so copies of one key collapse
    before the shuffle and a key with very many copies does not load one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*[c if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def clean_prices(df: DataFrame) -> DataFrame:
    """Bronze price rows to silver ones."""
    present = filter_not_null(df, PRICE_KEY)
    return drop_duplicates(cast_ints(present, ["market_cap"]), PRICE_KEY)


def clean_fundamentals(df: DataFrame) -> DataFrame:
    """Bronze fundamentals to silver ones, as a static table."""
    present = filter_not_null(df, FUNDAMENTALS_KEY)
    return add_categories(drop_duplicates(cast_ints(present, FUNDAMENTALS_AMOUNTS), FUNDAMENTALS_KEY))
