"""Hour keys and month-partition predicates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def extract_hour(column: str = "extract_time") -> Column:
    """``year-month-day-hour`` without zero padding; an unknown time gives the empty text."""
    c = F.col(column)
    return F.concat_ws("-", F.year(c), F.month(c), F.dayofmonth(c), F.hour(c))


def month_pairs(start: date, end: date) -> list[tuple[int, int]]:
    """Every (year, month) a date range touches."""
    months = range(start.year * 12 + start.month - 1, end.year * 12 + end.month)
    return [(m // 12, m % 12 + 1) for m in months]


def in_months(start: date, end: date) -> Column:
    """Predicate on the year and month partition columns that covers a date range."""
    pairs = [F.struct(F.lit(y), F.lit(m)) for y, m in month_pairs(start, end)]
    return F.struct("year", "month").isin(pairs)


def since_month(start: date) -> Column:
    """Predicate on the year and month partition columns: this month or a later one."""
    return (F.col("year") > start.year) | (
        (F.col("year") == start.year) & (F.col("month") >= start.month)
    )


def months_back(column: str, days: int) -> Column:
    """First days of every month between ``days`` before a date and the date itself."""
    end = F.trunc(column, "MM")
    return F.sequence(F.trunc(F.date_sub(column, days), "MM"), end, F.expr("INTERVAL 1 MONTH"))
