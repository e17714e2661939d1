from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions import buckets
from tickloom.functions.times import extract_hour, month_pairs
from tickloom.operators import cleaning, history
from tickloom.schemas import FUNDAMENTALS_FEED, TABLES


@pytest.mark.parametrize(
    ("category", "column", "steps"),
    [
        (buckets.market_cap_category, "marketCap", [(200e9, "Mega Cap"), (10e9, "Large Cap"), (2e9, "Mid Cap"), (None, "Small Cap")]),
        (buckets.employee_category, "fullTimeEmployees", [(10000.0, "Large Workforce"), (1000.0, "Medium Workforce"), (None, "Small Workforce")]),
        (buckets.margin_category, "profitMargins", [(0.2, "High Margin"), (0.05, "Moderate Margin"), (None, "Low Margin")]),
        (buckets.growth_category, "revenueGrowth", [(0.15, "High Growth"), (0.05, "Moderate Growth"), (None, "Low or Negative Growth")]),
    ],
)
def test_bucket_edges(spark, category, column, steps):
    for (bound, label), (_, below) in zip(steps, steps[1:]):
        rows = [(bound,), (bound * (1 - 1e-9),)]
        got = [r[0] for r in spark.createDataFrame(rows, f"{column} double").select(category()).collect()]
        assert got == [label, below]
    for odd in (None, -1.0):
        row = spark.createDataFrame([(odd,)], f"{column} double").select(category()).first()
        assert row[0] == steps[-1][1]


def test_filter_not_null_keeps_nan(spark):
    rows = [(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)]
    kept = cleaning.filter_not_null(spark.createDataFrame(rows, "x double, y string"), ["x", "y"])
    assert [r["y"] for r in kept.collect()] == ["a", "b"]


def test_filter_not_null_without_columns_keeps_all(spark):
    assert cleaning.filter_not_null(spark.range(3), []).count() == 3


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("12", 12),
        (" 12 ", 12),
        ("1.5E11", 150_000_000_000),
        ("-3.9", -3),
        ("9007199254740993", 9007199254740993),
        ("1e40", None),
        ("n/a", None),
        ("", None),
        (None, None),
    ],
)
def test_cast_ints_of_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert cleaning.cast_ints(df, ["v"]).first()["v"] == number


def test_cast_ints_of_doubles(spark):
    df = spark.createDataFrame([(1e11,), (float("nan"),), (1e300,), (None,)], "v double")
    assert [r["v"] for r in cleaning.cast_ints(df, ["v"]).collect()] == [10**11, None, None, None]


def test_drop_duplicates_is_the_same_on_every_partitioning(spark):
    rows = [(k, v, w) for k in range(20) for v, w in ((3, "c"), (1, "z"), (1, None))]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "k int, v int, w string").repartition(parts)
        got = sorted(tuple(r) for r in cleaning.drop_duplicates(df, ["k"]).collect())
        assert got == [(k, 1, None) for k in range(20)]


def test_drop_duplicates_with_key_columns_only(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (None, 2)], "a int, b int")
    assert cleaning.drop_duplicates(df, ["a", "b"]).count() == 2


def test_order_columns_puts_unknown_ones_last(spark):
    df = spark.createDataFrame([(1, 2, 3)], "zzz int, sector int, symbol int")
    assert cleaning.order_columns(df).columns == ["symbol", "sector", "zzz"]


def test_normalize_snapshot_fills_missing_fields(spark):
    df = spark.createDataFrame([("A", 1.5)], "symbol string, lastPrice double")
    row = cleaning.normalize_snapshot(df).first()
    assert row["current_price"] == 1.5 and row["market_cap"] is None


def test_stamp_partitions_shift_crosses_month_end(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 30, 23, 0),)], "t timestamp")
    row = cleaning.stamp_partitions(df, F.col("t"), shift_days=2).first()
    assert (row["extract_date"], row["year"], row["month"], row["day"]) == (date(2024, 2, 1), 2024, 2, 1)
    same = cleaning.stamp_partitions(df, F.col("t")).first()
    assert same["extract_date"] == date(2024, 1, 30)


def test_extract_hour_of_unknown_time_is_empty(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 5, 7, 1),), (None,)], "extract_time timestamp")
    assert [r[0] for r in df.select(extract_hour()).collect()] == ["2024-3-5-7", ""]


def test_month_pairs_cross_the_year():
    assert month_pairs(date(2023, 11, 30), date(2024, 2, 1)) == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]


def test_history_and_latest_row_bounds(spark):
    days = [date(2024, 3, 1), date(2024, 3, 5), date(2024, 3, 6), date(2023, 12, 7), date(2023, 12, 6)]
    df = spark.createDataFrame([("A", d, d.year, d.month) for d in days], "symbol string, date date, year int, month int")
    ranks = {r["date"]: r["rn"] for r in history.history_slice(df, date(2024, 3, 6)).collect()}
    assert ranks == {date(2024, 3, 6): 1, date(2024, 3, 5): 2, date(2024, 3, 1): 3, date(2023, 12, 7): 4}
    assert history.latest_row(df, date(2024, 3, 6)).first()["date"] == date(2024, 3, 5)
    assert history.latest_row(df, date(2024, 3, 11)).first()["date"] == date(2024, 3, 6)
    assert history.latest_row(df, date(2024, 3, 12)).first() is None


def test_clean_fundamentals_schema(spark):
    rows = spark.createDataFrame([], FUNDAMENTALS_FEED)
    assert cleaning.clean_fundamentals(rows).columns == TABLES["silver.fundamentals"].schema.names
