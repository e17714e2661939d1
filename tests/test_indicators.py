"""Indicators on hand-made bars, against plain Python that follows the definitions row by row."""

from __future__ import annotations

import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators
from tickloom.operators.history import newest_per_symbol
from tickloom.operators.cleaning import add_prev_prefix
from tickloom.operators.recurrence import BLOCK
from tickloom.plans.gold import refreshed_indicators
from tickloom.schemas import DAILY_BARS, DAILY_INDICATORS

START = date(2024, 1, 1)


def bars(spark, series, symbol="A"):
    """Bars from (day offset, price, volume) triples."""
    rows = []
    for offset, price, volume in series:
        d = START + timedelta(days=offset)
        rows.append((symbol, d, price, price, price, price, float(volume), d.year, d.month))
    return spark.createDataFrame(rows, DAILY_BARS)


def daily(prices):
    return [(i, float(p), 10 * (i + 1)) for i, p in enumerate(prices)]


def last(df):
    return df.orderBy(F.col("date").desc()).first()


def by_offset(df, column):
    return {(r["date"] - START).days: r[column] for r in df.collect()}


def test_newest_first_obv_is_zero_and_oldest_first_is_not(spark):
    rising = bars(spark, daily([1, 2, 3, 4, 5]))
    assert last(indicators.obv(rising))["obv"] == 0.0
    assert last(indicators.obv(rising, "oldest_first"))["obv"] == 20 + 30 + 40 + 50


def test_obv_falls_with_price_and_ignores_standstill(spark):
    mixed = bars(spark, daily([5, 4, 4, 6]))
    assert by_offset(indicators.obv(mixed, "oldest_first"), "obv") == {0: 0.0, 1: -20.0, 2: -20.0, 3: 20.0}


def test_rsi_without_any_loss_is_100(spark):
    rising = bars(spark, daily([1, 2, 3]))
    assert last(indicators.rsi(rising, [2], "oldest_first"))["rsi_2"] == 100.0
    assert last(indicators.rsi(rising, [2], "newest_first"))["rsi_2"] == 0.0


@pytest.mark.parametrize("order", indicators.ORDERS)
def test_rsi_of_flat_and_single_row_is_100(spark, order):
    for series in ([7], [7, 7, 7]):
        assert last(indicators.rsi(bars(spark, daily(series)), [12], order))["rsi_12"] == 100.0


def test_rsi_counts_tiny_losses(spark):
    near = bars(spark, daily([1.0, 1.0 - 1e-12, 1.5]))
    value = last(indicators.rsi(near, [12], "oldest_first"))["rsi_12"]
    assert 99.9 < value < 100.0


def test_rsi_uses_only_moves_inside_the_range(spark):
    # The oldest bar is 91 days back: its move belongs to no bar in range.
    far = bars(spark, [(0, 1.0, 1), (1, 9.0, 1), (50, 8.0, 1), (91, 9.0, 1)])
    assert last(indicators.rsi(far, [12], "oldest_first"))["rsi_12"] == pytest.approx(50.0)


def test_rsi_of_both_orders_adds_to_100(spark):
    mixed = bars(spark, daily([3, 5, 4, 6, 2, 8]))
    old = last(indicators.rsi(mixed, [4], "oldest_first"))["rsi_4"]
    new = last(indicators.rsi(mixed, [4], "newest_first"))["rsi_4"]
    assert old + new == pytest.approx(100.0)


def test_unknown_order_is_rejected(spark):
    with pytest.raises(ValueError, match="order"):
        indicators.obv(bars(spark, daily([1])), "sideways")


def test_bollinger_needs_a_full_window(spark):
    prices = [3.0, 5.0, 4.0, 8.0]
    bands = indicators.bollinger(bars(spark, daily(prices)), [4])
    upper = by_offset(bands, "bb_upper_4")
    assert upper[2] is None
    mean, dev = statistics.mean(prices), statistics.stdev(prices)
    assert upper[3] == pytest.approx(mean + 2 * dev)
    row = last(bands)
    assert row["bb_width_4"] == pytest.approx(row["bb_upper_4"] - row["bb_lower_4"])
    assert row["bb_upper_4"] >= row["bb_lower_4"]


def test_moving_average_takes_what_is_there_and_forgets_after_90_days(spark):
    sparse = bars(spark, [(0, 10.0, 1), (90, 20.0, 1), (91, 40.0, 1)])
    assert by_offset(indicators.sma(sparse, [12]), "ma_12") == {0: 10.0, 90: 15.0, 91: 30.0}


@pytest.mark.parametrize(("gap", "seeded"), [(5, False), (6, True)])
def test_ema_starts_again_after_more_than_five_days(spark, gap, seeded):
    series = [(0, 10.0, 1), (1, 20.0, 1), (1 + gap, 40.0, 1)]
    value = last(indicators.ema(bars(spark, series), [3]))["ema_3"]
    assert value == pytest.approx((10 + 20 + 40) / 3 if seeded else (10 * 0.5 + 20 * 0.5) * 0.5 + 40 * 0.5)


def python_ema(series, n, lookback=90, max_gap=5):
    out, previous, before = {}, None, None
    for offset, price, _ in series:
        recent = [p for o, p, _ in series if offset - lookback <= o <= offset][-n:]
        if before is None or offset - before > max_gap:
            previous = None
        k = 2 / (n + 1)
        mean = sum(recent) / len(recent)
        previous = mean if previous is None else previous * (1 - k) + price * k
        out[offset], before = previous, offset
    return out


@pytest.mark.parametrize("n", [1, 2, 12, 60])
def test_ema_over_many_blocks_equals_the_plain_recurrence(spark, n):
    rnd = random.Random(n)
    series, offset = [], 0
    for _ in range(BLOCK * 4 + 17):
        offset += rnd.choice([1, 1, 1, 2, 3, 5]) if rnd.random() > 0.004 else 9
        series.append((offset, rnd.uniform(1, 1000), 1))
    got = by_offset(indicators.ema(bars(spark, series), [n]), f"ema_{n}")
    want = python_ema(series, n)
    assert got.keys() == want.keys()
    assert max(abs(got[o] - want[o]) / want[o] for o in want) < 1e-11


def test_one_unbroken_segment_longer_than_a_block(spark):
    series = daily([100 + (i * 37) % 91 for i in range(BLOCK * 3)])
    got = by_offset(indicators.ema(bars(spark, series), [26]), "ema_26")
    want = python_ema(series, 26)
    assert max(abs(got[o] - want[o]) for o in want) < 1e-9


def test_a_day_without_price_has_no_ema_and_the_next_starts_again(spark):
    series = daily([10, 20, 30, 40])
    holed = bars(spark, series).withColumn("avg_price", F.when(F.col("volume") != 30, F.col("avg_price")))
    got = by_offset(indicators.ema(holed, [3]), "ema_3")
    assert got[2] is None
    assert got[3] == pytest.approx((20 + 40) / 2)


def test_macd_signal_and_histogram(spark):
    row = by_offset(indicators.macd(bars(spark, daily([10, 13]))), "macd")
    ema12, ema26 = 10 * 11 / 13 + 13 * 2 / 13, 10 * 25 / 27 + 13 * 2 / 27
    assert row[0] == 0.0
    assert row[1] == pytest.approx(ema12 - ema26)
    second = last(indicators.macd(bars(spark, daily([10, 13]))))
    assert second["signal"] == pytest.approx(0.2 * row[1])
    assert second["macd_hist"] == pytest.approx(0.8 * row[1])


def test_all_columns_in_table_order(spark):
    assert indicators.daily_indicators(bars(spark, daily([1, 2]))).columns == DAILY_INDICATORS.names


def test_other_windows_and_their_columns(spark):
    columns = indicators.daily_indicators(bars(spark, daily([1, 2])), windows=[5, 12, 26]).columns
    assert "ma_5" in columns and "bb_width_5" in columns and "ma_60" not in columns
    with pytest.raises(ValueError, match="12 and 26"):
        indicators.daily_indicators(bars(spark, daily([1, 2])), windows=[5])


def close(left, right):
    a = {(r["symbol"], r["date"]): r for r in left.collect()}
    b = {(r["symbol"], r["date"]): r for r in right.collect()}
    assert a.keys() == b.keys()
    for key, row in a.items():
        for x, y in zip(row, b[key]):
            assert x == (pytest.approx(y, abs=1e-9) if isinstance(y, float) else y), key


def test_continuing_from_stored_state_equals_one_run(spark):
    series = daily([50 + (i * 17) % 23 for i in range(140)])
    series = [s for s in series if not 100 < s[0] < 110]
    table = bars(spark, series).unionByName(bars(spark, series[40:], "B"))
    whole = indicators.daily_indicators(table)
    cut = START + timedelta(days=95)
    stored = whole.filter(F.col("date") < F.lit(cut))
    changed = table.filter(F.col("date") >= F.lit(cut))
    fresh = refreshed_indicators(changed, table, stored)
    close(fresh, whole.filter(F.col("date") >= F.lit(cut)))


def test_refresh_of_a_corrected_day_reaches_all_later_days(spark):
    series = daily([50 + (i * 17) % 23 for i in range(60)])
    outdated = indicators.daily_indicators(bars(spark, series))
    series[30] = (30, 500.0, 1)
    table = bars(spark, series)
    changed = table.filter(F.col("date") == F.lit(START + timedelta(days=30)))
    want = indicators.daily_indicators(table).filter(F.col("date") >= F.lit(START + timedelta(days=30)))
    close(refreshed_indicators(changed, table, outdated), want)
    only = refreshed_indicators(changed, table, outdated, refresh="batch")
    assert [r["date"] for r in only.collect()] == [START + timedelta(days=30)]


def test_refresh_without_changes(spark):
    empty = bars(spark, daily([1])).limit(0)
    assert refreshed_indicators(empty, empty, empty) is None


def test_state_is_the_newest_row_with_prefix(spark):
    state = add_prev_prefix(newest_per_symbol(bars(spark, daily([1, 2, 3])))).first()
    assert state["symbol"] == "A" and state["prev_avg_price"] == 3.0
