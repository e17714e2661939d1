"""Daily bars per symbol."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _measures() -> list[Column]:
    # Prices arrive as running values of the day: the day's open, high and volume are the
    # largest ones seen, the low is the smallest.
    return [
        F.max("open").alias("open"),
        F.max("day_high").alias("day_high"),
        F.min("day_low").alias("day_low"),
        F.avg("current_price").alias("avg_price"),
        F.max("volume").alias("volume"),
    ]


_COLUMNS = ["symbol", "date", "open", "day_high", "day_low", "avg_price", "volume", "year", "month"]


def daily_bars(prices: DataFrame) -> DataFrame:
    """One bar per symbol and calendar day of ``extract_time``.

    All measures combine before the shuffle, so each task sends one row per symbol and day,
    however many snapshots a symbol has. On a stream the groups are kept without end, because
    the day no longer carries the watermark.
    """
    keyed = prices.withColumn("date", F.to_date("extract_time"))
    return keyed.groupBy("symbol", "year", "month", "date").agg(*_measures()).select(*_COLUMNS)


def partial_bars(prices: DataFrame) -> DataFrame:
    """The bars of some prices with the sum and number of prices, from which bars of more prices follow."""
    keyed = prices.withColumn("date", F.to_date("extract_time"))
    sums = [F.sum("current_price").alias("price_sum"), F.count("current_price").alias("price_count")]
    return keyed.groupBy("symbol", "year", "month", "date").agg(*_measures(), *sums).select(*_COLUMNS, "price_sum", "price_count")


def _sum(side: Callable[[str], Column]) -> Column:
    # A bar that was stored without its sums counts as one price.
    return F.coalesce(side("price_sum"), side("avg_price"), F.lit(0.0))


def _count(side: Callable[[str], Column]) -> Column:
    return F.coalesce(side("price_count"), F.when(side("avg_price").isNotNull(), 1).otherwise(0).cast("long"))


#: How the bar of all prices follows from two partial ones.
MERGED = {
    "open": lambda a, b: F.greatest(a("open"), b("open")),
    "day_high": lambda a, b: F.greatest(a("day_high"), b("day_high")),
    "day_low": lambda a, b: F.least(a("day_low"), b("day_low")),
    "volume": lambda a, b: F.greatest(a("volume"), b("volume")),
    "avg_price": lambda a, b: F.try_divide(_sum(a) + _sum(b), _count(a) + _count(b)),
    "price_sum": lambda a, b: _sum(a) + _sum(b),
    "price_count": lambda a, b: _count(a) + _count(b),
}


def daily_bars_windowed(prices: DataFrame) -> DataFrame:
    """The same bars over tumbling one-day windows, whose state ends with the watermark."""
    grouped = prices.groupBy("symbol", F.window("extract_time", "1 day").alias("span")).agg(*_measures())
    day = F.to_date("span.start")
    return grouped.withColumns({"date": day, "year": F.year(day), "month": F.month(day)}).select(*_COLUMNS)
