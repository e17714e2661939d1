from __future__ import annotations

import glob
import os
import uuid
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickloom.config import Lakehouse, shared_folder
from tickloom.functions import partitions
from tickloom.operators import upsert as module
from tickloom.operators.bars import MERGED
from tickloom.operators.upsert import DuplicateKeyError, MovedPartitionError, feed_path, merge_into, merged, upsert
from tickloom.schemas import DAILY_BARS, TABLES
from tickloom.sinks import catalog
from tickloom.sinks.catalog import in_partitions, read_target, vacuum

SPEC = TABLES["silver.daily_price_aggregates"]


def bars(spark, rows):
    """(symbol, date, price) as bars; every measure is the price."""
    full = [(s, d, p, p, p, p, p, d.year, d.month) for s, d, p in rows]
    return spark.createDataFrame(full, DAILY_BARS)


def stored(spark, target, column="avg_price"):
    return {(r["symbol"], r["date"]): r[column] for r in read_target(spark, target).collect()}


JAN, FEB, MAR = date(2024, 1, 5), date(2024, 2, 5), date(2024, 3, 5)


@pytest.fixture
def target(spark):
    return Lakehouse(shared_folder(spark, "upsert"), env=f"e{uuid.uuid4().hex}").target("silver.daily_price_aggregates")


def test_insert_update_and_keep(spark, target):
    upsert(bars(spark, [("A", JAN, 1.0), ("A", FEB, 2.0), ("B", JAN, 3.0)]), target)
    upsert(bars(spark, [("A", FEB, 20.0), ("C", FEB, 4.0), ("C", MAR, 5.0)]), target)
    want = {("A", JAN): 1.0, ("A", FEB): 20.0, ("B", JAN): 3.0, ("C", FEB): 4.0, ("C", MAR): 5.0}
    assert stored(spark, target) == want


def test_only_listed_columns_change_on_a_match(spark, target):
    upsert(bars(spark, [("A", JAN, 1.0)]), target, ["avg_price"])
    upsert(bars(spark, [("A", JAN, 9.0), ("B", JAN, 7.0)]), target, ["avg_price"])
    assert stored(spark, target) == {("A", JAN): 9.0, ("B", JAN): 7.0}
    assert stored(spark, target, "volume") == {("A", JAN): 1.0, ("B", JAN): 7.0}


def test_an_update_may_set_null(spark, target):
    upsert(bars(spark, [("A", JAN, 1.0)]), target, ["avg_price"])
    upsert(bars(spark, [("A", JAN, None)]), target, ["avg_price"])
    assert stored(spark, target) == {("A", JAN): None}


def test_repeating_an_upsert_changes_nothing(spark, target):
    changes = bars(spark, [("A", JAN, 1.0), ("B", FEB, 2.0)])
    for _ in range(3):
        upsert(changes, target)
    assert stored(spark, target) == {("A", JAN): 1.0, ("B", FEB): 2.0}


def test_empty_changes_touch_nothing(spark, target):
    upsert(bars(spark, []), target)
    assert not os.path.exists(target.path) and stored(spark, target) == {}


def test_repeated_key_is_refused_before_anything_is_written(spark, target):
    upsert(bars(spark, [("A", JAN, 1.0)]), target)
    with pytest.raises(DuplicateKeyError):
        upsert(bars(spark, [("A", JAN, 2.0), ("A", JAN, 3.0)]), target)
    assert stored(spark, target) == {("A", JAN): 1.0}


def test_partition_that_contradicts_the_date_is_refused(spark, target):
    wrong = bars(spark, [("A", JAN, 1.0)]).selectExpr("* except (month)", "2 as month")
    with pytest.raises(MovedPartitionError):
        upsert(wrong, target)


def test_an_unknown_date_is_refused(spark, target):
    undated = bars(spark, [("A", JAN, 1.0)]).selectExpr(
        "symbol", "CAST(NULL AS DATE) AS date", "* except (symbol, date)"
    )
    with pytest.raises(MovedPartitionError):
        upsert(undated, target)


def test_untouched_partitions_keep_their_files(spark, target):
    upsert(bars(spark, [("A", JAN, 1.0), ("A", FEB, 2.0)]), target)
    files = lambda month: {r[0] for r in spark.table(target.name).where(f"month = {month}").select("_metadata.file_path").distinct().collect()}
    january, february = files(1), files(2)
    upsert(bars(spark, [("A", FEB, 3.0)]), target)
    assert files(1) == january
    assert files(2) != february


def test_touched_by_prunes_partitions_of_the_scan(spark, tmp_path):
    path = str(tmp_path / "bars")
    bars(spark, [("A", JAN, 1.0), ("A", FEB, 2.0)]).write.partitionBy("year", "month").parquet(path)
    table = spark.read.parquet(path)
    kept = partitions.touched_by(table, bars(spark, [("X", FEB, 0.0)]), ["year", "month"])
    assert kept.count() == 1
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = kept.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "year" in filters and "2024" in filters and "month" in filters
    assert partitions.touched_by(table, bars(spark, []), ["year", "month"]).count() == 0


class Crash(Exception):
    pass


STEPS = ["touched_partitions", "merged", "point", "write_batch", "mark"]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_crash_at_any_step_leaves_old_or_new_rows_and_a_retry_ends_it(spark, target, monkeypatch, step, after):
    upsert(bars(spark, [("A", JAN, 1.0), ("A", FEB, 2.0), ("A", MAR, 3.0)]), target)
    old, new = {("A", JAN): 1.0, ("A", FEB): 2.0, ("A", MAR): 3.0}, {("A", JAN): 11.0, ("A", FEB): 22.0, ("A", MAR): 3.0}
    changes = bars(spark, [("A", JAN, 10.0), ("A", FEB, 20.0)])
    add = {"avg_price": lambda a, b: a("avg_price") + b("avg_price")}
    real = getattr(module, step)

    def crash(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise Crash

    monkeypatch.setattr(module, step, crash)
    with pytest.raises(Crash):
        upsert(changes, target, tag="t-1", combine=add)
    assert stored(spark, target) in (old, new)
    monkeypatch.undo()
    for _ in range(2):
        upsert(changes, target, tag="t-1", combine=add)
        assert stored(spark, target) == new
    feed = spark.read.parquet(feed_path(target.path)).where("batch_tag = 't-1'")
    assert sorted(r["date"] for r in feed.collect()) == [JAN, FEB]


def test_a_crash_between_two_partitions_leaves_each_old_or_new(spark, target, monkeypatch):
    upsert(bars(spark, [("A", JAN, 1.0), ("A", FEB, 2.0)]), target)
    changes = bars(spark, [("A", JAN, 10.0), ("A", FEB, 20.0)])
    real = module.point

    def half(spark, target, touched, folder):
        real(spark, target, touched[:1], folder)
        raise Crash

    monkeypatch.setattr(module, "point", half)
    with pytest.raises(Crash):
        upsert(changes, target, tag="t-1")
    now = stored(spark, target)
    assert len(now) == 2 and now["A", JAN] in (1.0, 10.0) and now["A", FEB] in (2.0, 20.0)
    monkeypatch.undo()
    upsert(changes, target, tag="t-1")
    assert stored(spark, target) == {("A", JAN): 10.0, ("A", FEB): 20.0}


def test_a_reader_that_planned_before_still_finds_its_rows(spark, target):
    upsert(bars(spark, [("A", JAN, 1.0)]), target)
    early = read_target(spark, target)
    upsert(bars(spark, [("A", JAN, 2.0)]), target)
    assert [r["avg_price"] for r in early.collect()] in ([1.0], [2.0])
    assert stored(spark, target) == {("A", JAN): 2.0}


def test_the_merge_scans_the_table_once_and_shuffles_once(spark, target):
    upsert(bars(spark, [("A", JAN, 1.0), ("A", FEB, 2.0), ("A", MAR, 3.0)]), target)
    changes = bars(spark, [("A", FEB, 9.0)])
    touched = changes.select("year", "month").collect()
    old = spark.table(target.name).filter(in_partitions(touched, ["year", "month"]))
    plan = merged(old, changes, SPEC, ["avg_price"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning(year") == plan.count("Exchange ") == 1 and "Join" not in plan
    assert [f.split("/")[-2] for f in old.inputFiles()] == ["month=2"]


def test_large_partitions_are_split_over_tasks(spark, target):
    rows = [(f"S{i}", JAN, float(i)) for i in range(200)]
    upsert(bars(spark, rows), target, splits=4)
    upsert(bars(spark, [("S7", JAN, 0.5)]), target, splits=4)
    assert stored(spark, target) == {(s, d): 0.5 if s == "S7" else p for s, d, p in rows}


def test_the_feed_tells_of_real_changes_only(spark, target):
    upsert(bars(spark, [("A", JAN, 1.0), ("B", JAN, 2.0)]), target, tag="one")
    upsert(bars(spark, [("A", JAN, 1.0), ("B", JAN, 3.0), ("C", JAN, None)]), target, tag="two")
    feed = spark.read.parquet(feed_path(target.path)).where("batch_tag = 'two'")
    assert {r["symbol"] for r in feed.collect()} == {"B", "C"}


def test_a_catalog_that_forgot_the_table_is_filled_again(spark, target):
    upsert(bars(spark, [("A", JAN, 1.0), ("A", FEB, 2.0)]), target)
    upsert(bars(spark, [("A", FEB, 20.0)]), target)
    spark.sql(f"DROP TABLE {target.name}")
    assert stored(spark, target) == {("A", JAN): 1.0, ("A", FEB): 20.0}


def test_vacuum_deletes_replaced_folders_only(spark, target):
    for price in (1.0, 2.0, 3.0):
        upsert(bars(spark, [("A", JAN, price)]), target)
    upsert(bars(spark, [("A", FEB, 9.0)]), target)
    folders = lambda: glob.glob(f"{target.path}_versions/*/year=2024/month=*")
    assert len(folders()) == 4 and vacuum(spark, target) == 0 and len(folders()) == 4
    assert vacuum(spark, target, keep_hours=-1) == 2 and len(folders()) == 2
    assert stored(spark, target) == {("A", JAN): 3.0, ("A", FEB): 9.0}
    assert catalog.vacuum(spark, target, keep_hours=-1) == 0


def test_partial_bars_merge_to_the_average_of_all_prices(spark, target):
    part = lambda price, n, tag: upsert(
        bars(spark, [("A", JAN, price)]).withColumns({"price_sum": F.lit(price * n), "price_count": F.lit(n).cast("long")}), target, tag=tag, combine=MERGED
    )
    part(1.0, 3, "a")
    part(5.0, 1, "b")
    part(5.0, 1, "b")
    assert stored(spark, target) == {("A", JAN): 2.0} and stored(spark, target, "day_low") == {("A", JAN): 1.0}
    upsert(bars(spark, [("A", JAN, 7.0)]), target)
    part(1.0, 2, "c")
    assert stored(spark, target) == {("A", JAN): 3.0}


def test_merge_statement_is_refused_by_plain_parquet(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS merge_target (symbol STRING, date DATE, avg_price DOUBLE) USING parquet")
    changes = bars(spark, [("A", JAN, 1.0)]).select("symbol", "date", "avg_price")
    for update in (None, ["avg_price"]):
        with pytest.raises(PySparkException, match="MERGE"):
            merge_into(changes, "merge_target", ["symbol", "date"], update)
    spark.sql("DROP TABLE merge_target")
