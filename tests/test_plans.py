"""Physical plans: what is read, what is shuffled, and what must not appear."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from tickloom.config import Lakehouse, shared_folder
from tickloom.functions.partitions import touched_by
from tickloom.operators import history, indicators, quality
from tickloom.operators.bars import daily_bars
from tickloom.operators.upsert import merge_rows
from tickloom.registry import batch, views
from tickloom.registry.views import view
from tickloom.schemas import TABLES
from tickloom.sinks.files import append_table
from tickloom.sources.tables import read_table
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"
KEY = "silver.daily_price_aggregates"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bars_table(spark):
    path = Lakehouse(shared_folder(spark, "plans")).path(KEY)
    append_table(view(spark, SF, views.BARS), path, TABLES[KEY].partition_by)
    return read_table(spark, path, TABLES[KEY].schema)


def test_all_indicators_need_one_shuffle(bars_table):
    text = plan(indicators.daily_indicators(bars_table))
    assert text.count("Exchange") == 1
    assert "Exchange hashpartitioning(symbol" in text
    assert "Join" not in text and "Python" not in text


def test_bars_combine_before_the_shuffle_and_read_few_columns(spark):
    text = plan(daily_bars(view(spark, SF, views.TICKS)))
    assert text.count("Exchange") == 1
    assert text.index("partial_max") > text.index("Exchange")
    assert "user_id" not in text and "props" not in text


def test_history_reads_only_the_months_in_range(bars_table):
    text = plan(history.history_slice(bars_table, date(1998, 6, 15)))
    filters = text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "1998" in filters and "year" in filters and "month" in filters
    pushed = text.split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(date,1998-03-17)" in pushed and "LessThanOrEqual(date,1998-06-15)" in pushed


def test_latest_row_combines_before_the_shuffle(bars_table):
    text = plan(history.latest_row(bars_table, date(1998, 6, 15)))
    assert text.index("partial_max") > text.index("Exchange")


def test_checks_with_one_key_read_the_table_once(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    checks = [
        quality.NonNegativeCheck(["l_quantity"]),
        quality.RowCountCheck(1),
        quality.UniquenessCheck(["l_orderkey", "l_linenumber"]),
        quality.NullCheck(["l_orderkey", "l_linenumber"]),
    ]
    text = plan(quality.evaluate(lines, checks, quality.LogContext("t", "Silver", datetime(2024, 1, 1))))
    assert text.count("FileScan") == 1
    assert "l_extendedprice" not in text


def test_delivery_pairs_are_counted_before_the_join(spark):
    ticks = view(spark, SF, views.TICKS)
    ctx = quality.LogContext("t", "Bronze", datetime(2024, 1, 15))
    text = plan(quality.duplicate_delivery_check(ticks, ticks, ctx, "month"))
    join = text.index("Join")
    assert text.count("partial_count", join) == 2


def test_a_small_change_does_not_shuffle_the_stored_rows(bars_table):
    changes = bars_table.filter("date = DATE '1998-06-15'")
    for update in (None, ["avg_price"]):
        text = plan(merge_rows(bars_table, changes, ["symbol", "date"], update))
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


# Queries that write a table first return a plain scan of it.
WRITERS = {"upsert_daily_bars", "upsert_indicators", "ddl_catalog", "file_inventory", "symbol_list"}


@pytest.mark.parametrize("name", sorted(set(batch.QUERIES) - WRITERS))
def test_no_plan_pairs_everything_or_leaves_the_jvm(spark, name):
    text = plan(batch.QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition, REPARTITION"):
        assert node not in text


def test_smoothing_sorts_few_times(bars_table):
    assert plan(indicators.daily_indicators(bars_table)).count("Sort [") <= 3


def test_partitions_are_pruned_for_any_number_of_changes(spark, bars_table):
    some = bars_table.filter("date BETWEEN DATE '1993-01-01' AND DATE '1997-12-31'")
    text = plan(touched_by(bars_table, some, ["year", "month"]))
    filters = text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    first = some.agg({"year": "min"}).first()[0]
    assert f">= {first}" in filters and "<= 1997" in filters
