"""Every query against its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, queries
from tests.compare import differences
from tests.conftest import DATA
from tickloom.registry import batch, streams
from tickloom.registry.oracle import ORACLE

# sf0.001 has sparse bars with gaps, sf0.01 has long unbroken histories.
LONG = ("sma", "ema", "macd", "bollinger", "daily_indicators", "rsi_oldest_first", "obv_oldest_first")
CASES = [(name, "0.001") for name in ORACLE] + [(name, "0.01") for name in LONG]


@pytest.mark.parametrize(("name", "sf"), CASES)
def test_query_matches_sql(spark, name, sf):
    sf_dir = f"{DATA}/sf{sf}"
    assert differences(queries()[name](spark, sf_dir), ORACLE[name], sf_dir)[:3] == []


def test_every_query_has_sql():
    assert {*batch.QUERIES, *streams.QUERIES} - set(ORACLE) == set()
    assert set(ORACLE) <= set(queries())


def test_entry_returns_rows(spark):
    assert entry(spark).limit(1).count() == 1
