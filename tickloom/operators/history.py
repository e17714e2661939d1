"""Bounded history, previous state and running values over daily bars.

A symbol has at most one bar per calendar day: bars come from a grouping on (symbol, date) and
are stored by an upsert that rejects repeated keys. A window over one symbol therefore holds a
few thousand small rows, no matter how many snapshots the symbol has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tickloom.functions.times import in_months


def newest_first(ts_col: str = "date") -> WindowSpec:
    return Window.partitionBy("symbol").orderBy(F.col(ts_col).desc())


def history_slice(bars: DataFrame, as_of: date, lookback_days: int = 90, ts_col: str = "date") -> DataFrame:
    """Rows of the last ``lookback_days`` up to and including ``as_of``, ranked newest first.

    ``ts_col`` is a date or, for hourly history, a timestamp; the day of ``as_of`` counts whole.
    """
    start = as_of - timedelta(days=lookback_days)
    if bars.schema[ts_col].dataType == DateType():
        inside = F.col(ts_col).between(F.lit(start), F.lit(as_of))
    else:
        inside = (F.col(ts_col) >= F.lit(start)) & (F.col(ts_col) < F.lit(as_of + timedelta(days=1)))
    recent = bars.filter(in_months(start, as_of) & inside)
    return recent.withColumn("rn", F.row_number().over(newest_first(ts_col)))


def latest_row(table: DataFrame, as_of: date, within_days: int = 5, ts_col: str = "date") -> DataFrame:
    """Each symbol's newest row in the ``within_days`` before ``as_of``, that day excluded."""
    start = as_of - timedelta(days=within_days)
    c = F.col(ts_col)
    recent = table.filter(in_months(start, as_of) & (c >= F.lit(start)) & (c < F.lit(as_of)))
    return newest_per_symbol(recent, ts_col)


def newest_per_symbol(rows: DataFrame, ts_col: str = "date") -> DataFrame:
    """Each symbol's row with the largest ``ts_col``, as an aggregate that combines map-side."""
    rest = [c for c in rows.columns if c not in ("symbol", ts_col)]
    newest = rows.groupBy("symbol").agg(F.max(F.struct(ts_col, *rest)).alias("_row"))
    return newest.select(*[c if c == "symbol" else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def join_prev_state(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Put each symbol's previous state, already prefixed, beside its rows."""
    return rows.join(state, "symbol", "left")


def price_diff(bars: DataFrame) -> DataFrame:
    """Price of a day minus the price of the next newer day; NULL on the newest."""
    newer = F.lag("avg_price").over(newest_first())
    return bars.withColumn("price_diff", F.col("avg_price") - newer)


def signed_volume(diff: Column, volume: Column) -> Column:
    """The volume with the sign of the price difference; 0 when it is zero or unknown."""
    return F.when(diff > 0, volume).when(diff < 0, -volume).otherwise(F.lit(0.0))


def obv_running(bars: DataFrame) -> DataFrame:
    """Running signed volume from the newest day backwards."""
    changed = price_diff(bars).withColumn("obv_change", signed_volume(F.col("price_diff"), F.col("volume")))
    total = F.sum("obv_change").over(newest_first().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return changed.withColumn("obv", total)


def distinct_dates(bars: DataFrame) -> DataFrame:
    return bars.select("date").distinct().orderBy("date")


def outer_join_fold(frames: Sequence[DataFrame], on: str = "symbol") -> DataFrame:
    """Full outer join of several per-symbol results."""
    return reduce(lambda left, right: left.join(right, on, "outer"), frames)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
