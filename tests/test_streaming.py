from __future__ import annotations

import glob
import os
import time
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.config import Lakehouse, shared_folder
from tickloom.operators import indicators
from tickloom.operators.bars import daily_bars
from tickloom.operators.upsert import feed_path, upsert
from tickloom.plans.gold import refreshed_indicators
from tickloom.plans.landing import land
from tickloom.plans.setup import refresh_partitions, set_up
from tickloom.schemas import DQ_LOG, FUNDAMENTALS_FEED, PRICE_FEED, TABLES
from tickloom.sinks.catalog import read_target
from tickloom.sinks.files import batch_tag, drain_batches, drain_to_table, write_batch
from tickloom.sources import feeds
from tickloom.sources.feeds import stream_feed
from tickloom.sources.tables import read_table, select_all, stream_catalog_table, stream_table
from tickloom.streaming import bronze, gold, silver

NOON = datetime(2024, 1, 10, 12)


@pytest.fixture
def lake(spark):
    return Lakehouse(shared_folder(spark, "test"), env=f"e{uuid.uuid4().hex}")


def prices(spark, rows):
    """Price rows from (symbol, price, time); volume is ten times the price."""
    full = [
        (s, p, p, p, p, p, None if p is None else 10 * p, p, t, t and t.date(), t and t.year, t and t.month, t and t.day)
        for s, p, t in rows
    ]
    return spark.createDataFrame(full, PRICE_FEED)


def deliver(rows, lake, key):
    if key.startswith("silver"):
        rows = rows.withColumn("market_cap", F.col("market_cap").cast("long"))
    write_batch(rows, lake.path(key), TABLES[key].partition_by, f"load-{uuid.uuid4().hex}")


def stored(spark, lake, key):
    if TABLES[key].versioned:
        return read_target(spark, lake.target(key))
    return read_table(spark, lake.path(key), TABLES[key].schema, missing_ok=True)


def symbols(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "symbol string")


def fetched(spark, *names):
    rows = [(n, 1.5, 2.5) for n in names]
    return spark.createDataFrame(rows, "symbol string, lastPrice double, marketCap double")


def test_landed_files_are_ingested_once_across_restarts(spark, lake):
    at = F.lit(NOON).cast("timestamp")
    land(fetched(spark, "A", "B"), lake, "pric", at)
    bronze.ingest_prices(spark, lake)
    bronze.ingest_prices(spark, lake)
    land(fetched(spark, "C"), lake, "pric", at, shift_days=30)
    bronze.ingest_prices(spark, lake, max_files=1)
    rows = stored(spark, lake, "bronze.prices").orderBy("symbol").collect()
    assert [(r["symbol"], r["month"], r["extract_time"]) for r in rows] == [
        ("A", 1, NOON),
        ("B", 1, NOON),
        ("C", 2, NOON + timedelta(days=30)),
    ]


def test_wrong_flag_is_refused(spark, lake):
    with pytest.raises(ValueError, match="wrong flag"):
        land(fetched(spark, "A"), lake, "other", F.lit(NOON))


@pytest.mark.parametrize("spread", [False, True])
def test_a_fundamentals_snapshot_passes_all_layers(spark, lake, spread):
    rows = spark.createDataFrame(
        [("A", "Alpha", 3e11, 20000.0), ("A", "Alpha", 3e11, 20000.0), ("B", None, 1.0, 1.0)],
        "symbol string, shortName string, marketCap double, fullTimeEmployees double",
    )
    missing = [c for c in FUNDAMENTALS_FEED.names[:26] if c not in rows.columns]
    rows = rows.select("*", *[F.lit(None).cast(FUNDAMENTALS_FEED[c].dataType).alias(c) for c in missing])
    for _ in range(2):
        land(rows, lake, "fund", F.lit(NOON).cast("timestamp"))
        bronze.ingest_fundamentals(spark, lake)
        silver.refine_fundamentals(spark, lake, spread)
    assert stored(spark, lake, "bronze.fundamentals").count() == 6
    (row,) = stored(spark, lake, "silver.fundamentals").collect()
    assert (row["marketCap"], row["marketCapCategory"]) == (300_000_000_000, "Mega Cap")
    assert (row["employeeCountCategory"], row["profitMarginCategory"]) == ("Large Workforce", "Low Margin")


def test_a_stateful_stream_writes_one_file_per_small_partition(spark, lake):
    rows = [(i, i % 3, NOON) for i in range(60)]
    folder = f"{lake.root}/spread"
    spark.createDataFrame(rows, "k int, p int, t timestamp").repartition(8).write.parquet(folder)
    stream = spark.readStream.schema("k int, p int, t timestamp").parquet(folder).withWatermark("t", "1 day")
    drain_to_table(stream.dropDuplicates(["k", "t"]), f"{lake.root}/few", ["p"], lake.checkpoint("few"))
    files = spark.read.parquet(f"{lake.root}/few").select("p", "_metadata.file_name").distinct()
    assert files.count() == 3


def test_copies_in_many_files_are_one_row(spark, lake):
    schema = "k string, extract_time timestamp"
    for _ in range(2):
        copies = spark.createDataFrame([("hot", NOON)] * 40 + [("cold", NOON)], schema)
        copies.repartition(8).write.mode("append").parquet(f"{lake.root}/copies")
        for spread in (False, True):
            stream = spark.readStream.schema(schema).parquet(f"{lake.root}/copies")
            unique = silver.unique_so_far(stream.withWatermark("extract_time", "2 days"), ["k", "extract_time"], spread)
            drain_to_table(unique, f"{lake.root}/out{spread}", ["k"], lake.checkpoint(f"copies{spread}"))
    for spread in (False, True):
        assert spark.read.parquet(f"{lake.root}/out{spread}").count() == 2


def test_late_fundamentals_are_dropped(spark, lake):
    def snapshot(name, at):
        base = spark.createDataFrame([(name, name)], "symbol string, shortName string")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in FUNDAMENTALS_FEED.fields[2:26]]
        stamp = [F.lit(at).cast("timestamp").alias("extract_time"), F.lit(at.date()).alias("extract_date")]
        parts = [F.lit(at.year).alias("year"), F.lit(at.month).alias("month"), F.lit(at.day).alias("day")]
        return base.select("*", *empty, *stamp, *parts)

    for name, at in (("A", NOON), ("LATE", NOON - timedelta(days=3)), ("OLD", NOON - timedelta(days=1))):
        deliver(snapshot(name, at), lake, "bronze.fundamentals")
        silver.refine_fundamentals(spark, lake)
    assert {r["symbol"] for r in stored(spark, lake, "silver.fundamentals").collect()} == {"A", "OLD"}


def test_gate_lets_a_complete_snapshot_through(spark, lake):
    deliver(prices(spark, [("A", 1.0, NOON), ("B", 2.0, NOON)]), lake, "bronze.prices")
    silver.refine_prices(spark, lake, symbols(spark, "A", "B"), as_of=NOON)
    assert stored(spark, lake, "silver.prices").count() == 2
    log = stored(spark, lake, "logging.dq_log")
    assert log.filter("status = 'PASS'").count() == log.count() == 6


def test_gate_stops_the_stream_before_anything_is_stored(spark, lake):
    deliver(prices(spark, [("A", 1.0, NOON)]), lake, "bronze.prices")
    with pytest.raises(StreamingQueryException, match="Exact row count check failed"):
        silver.refine_prices(spark, lake, symbols(spark, "A", "B"), as_of=NOON)
    assert stored(spark, lake, "silver.prices").count() == 0
    names = [r["check_name"] for r in stored(spark, lake, "logging.dq_log").collect()]
    assert sorted(names) == ["non_negative_check_current_price", "row_count_exact_check"]
    # The failed batch was not marked as done: it comes again.
    silver.refine_prices(spark, lake, symbols(spark, "A"), as_of=NOON)
    assert stored(spark, lake, "silver.prices").count() == 1


def test_quarantine_sets_a_failed_batch_aside(spark, lake):
    gate = {"gate": "quarantine", "as_of": NOON}
    deliver(prices(spark, [("A", -1.0, NOON)]), lake, "bronze.prices")
    silver.refine_prices(spark, lake, symbols(spark, "A"), **gate)
    deliver(prices(spark, [("A", 1.0, NOON)]), lake, "bronze.prices")
    silver.refine_prices(spark, lake, symbols(spark, "A"), **gate)
    assert [r["current_price"] for r in stored(spark, lake, "silver.prices").collect()] == [1.0]
    aside = spark.read.parquet(lake.path("silver.prices") + "_quarantine").collect()
    assert [r["current_price"] for r in aside] == [-1.0]


def test_unknown_gate_mode(spark, lake):
    with pytest.raises(ValueError, match="gate"):
        silver.refine_prices(spark, lake, symbols(spark, "A"), gate="ignore")


def test_prices_are_unique_within_a_batch_only(spark, lake):
    for _ in range(2):
        deliver(prices(spark, [("A", 1.0, NOON), ("A", 1.0, NOON), ("A", None, NOON)]), lake, "bronze.prices")
        silver.refine_prices(spark, lake, symbols(spark, "A"), gate="log", as_of=NOON)
    assert stored(spark, lake, "silver.prices").count() == 2


def test_a_second_checkpoint_adds_and_a_replay_keeps_what_is_there(spark, lake):
    key = "silver.prices"
    rows = prices(spark, [("A", 1.0, NOON)]).withColumn("market_cap", F.lit(1).cast("long"))
    path, parts = lake.path(key), TABLES[key].partition_by
    files = set()
    for tag in ("q1-0", "q1-0", "q2-0"):
        write_batch(rows, path, parts, tag)
        files |= {r[0] for r in spark.read.parquet(path).select("_metadata.file_name").distinct().collect()}
    assert stored(spark, lake, key).count() == 2 and len(files) == 2


def test_a_batch_without_its_marker_is_replaced(spark, lake):
    key = "silver.prices"
    rows = prices(spark, [("A", 1.0, NOON)]).withColumn("market_cap", F.lit(1).cast("long"))
    path, parts = lake.path(key), TABLES[key].partition_by
    rows.withColumn("batch_tag", F.lit("q1-0")).write.partitionBy(*parts, "batch_tag").parquet(path)
    write_batch(rows, path, parts, "q1-0")
    assert stored(spark, lake, key).count() == 1


def test_a_bronze_replay_does_not_reach_silver_and_bars(spark, lake):
    rows = prices(spark, [("A", 1.0, NOON), ("A", 3.0, NOON)])
    for _ in range(2):
        write_batch(rows, lake.path("bronze.prices"), TABLES["bronze.prices"].partition_by, "q-0")
        silver.refine_prices(spark, lake, symbols(spark, "A"), gate="log", as_of=NOON)
        silver.roll_daily_bars(spark, lake)
    assert stored(spark, lake, "silver.prices").count() == 2
    assert stored(spark, lake, "logging.dq_log").count() == 6
    assert bars_by_key(stored(spark, lake, "silver.daily_price_aggregates"))["A", NOON.date()] == (2.0, 30.0)


def test_a_retried_gate_leaves_the_log_unchanged(spark, lake):
    deliver(prices(spark, [("A", -1.0, NOON)]), lake, "bronze.prices")
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            silver.refine_prices(spark, lake, symbols(spark, "A"), as_of=NOON)
        assert stored(spark, lake, "logging.dq_log").count() == 1


def test_a_repaired_gate_logs_the_attempt_that_was_stored(spark, lake):
    deliver(prices(spark, [("A", 1.0, NOON), ("B", 1.0, NOON)]), lake, "bronze.prices")
    with pytest.raises(StreamingQueryException):
        silver.refine_prices(spark, lake, symbols(spark, "A"), as_of=NOON)
    # The list of symbols is repaired and the batch tried again a day later.
    silver.refine_prices(spark, lake, symbols(spark, "A", "B"), as_of=NOON + timedelta(days=1))
    log = stored(spark, lake, "logging.dq_log").collect()
    assert {r["status"] for r in log} == {"PASS"} and {r["day"] for r in log} == {11}
    assert stored(spark, lake, "silver.prices").count() == 2


HEADER = ",".join(PRICE_FEED.names)
LINE = "{},1.5,1,2,1,1,10,5,2024-01-10T12:00:00.000000,2024-01-10,2024,1,10"


def feed_file(lake, name, *lines):
    folder = f"{lake.landing(lake.price_feed)}/2024/1"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as out:
        out.write("".join(f"{line}\n" for line in lines))


def set_aside(spark, lake):
    rows = spark.read.parquet(bronze.misfits_path(lake.path("bronze.prices")))
    return sorted((os.path.basename(r["source_file"]), r["reason"], r["line"]) for r in rows.collect())


def test_lines_that_do_not_fit_are_set_aside(spark, lake):
    swapped = HEADER.replace("current_price,open", "open,current_price")
    few, many, word = LINE.format("F")[:-3], LINE.format("M") + ",7", LINE.format("W").replace("1.5", "n/a")
    feed_file(lake, "good", HEADER, LINE.format("A"), "", few, many, word)
    feed_file(lake, "styled", '"' + HEADER.upper().replace(",", '", "') + '"', LINE.format("B"), LINE.format("").replace("1.5", ""))
    feed_file(lake, "swapped", swapped, LINE.format("C"))
    feed_file(lake, "headless", LINE.format("D"))
    feed_file(lake, "only_header", HEADER)
    feed_file(lake, "empty")
    for _ in range(2):
        bronze.ingest_prices(spark, lake)
    kept = {(r["symbol"], r["current_price"], r["extract_time"]) for r in stored(spark, lake, "bronze.prices").collect()}
    assert kept == {("A", 1.5, NOON), ("B", 1.5, NOON), (None, None, NOON)}
    assert set_aside(spark, lake) == sorted(
        [
            *[("good.csv", "row", line) for line in (few, many, word)],
            ("swapped.csv", "header", swapped),
            ("swapped.csv", "header", LINE.format("C")),
            ("headless.csv", "header", LINE.format("D")),
        ]
    )


def test_without_strict_columns_go_by_position(spark, lake):
    feed_file(lake, "other", HEADER.replace("symbol", "ticker"), LINE.format("A").replace("1.5", "n/a"))
    bronze.ingest_prices(spark, lake, strict=False)
    (row,) = stored(spark, lake, "bronze.prices").collect()
    assert (row["symbol"], row["current_price"], row["open"]) == ("A", None, 1.0)


@pytest.mark.parametrize("misfit", [False, True])
def test_a_crash_before_misfits_are_set_aside_is_mended(spark, lake, misfit):
    lines = [("f", HEADER), ("f", LINE.format("A")), *([("f", "x")] if misfit else [])]
    batch = spark.createDataFrame(lines, "source_file string, line string")
    spec, path = TABLES["bronze.prices"], lake.path("bronze.prices")
    rows, all_fit = feeds.fitted(batch, spec.schema)
    assert all_fit != misfit
    rows = rows.filter("reason IS NULL").select("row.*").select(*spec.schema.names)
    write_batch(rows, path, spec.partition_by, "q-0")  # the driver dies here
    for _ in range(2):
        bronze.store_fitting(batch, spec, path, "q-0")
        assert stored(spark, lake, "bronze.prices").count() == 1
        aside = read_table(spark, bronze.misfits_path(path), StructType.fromDDL(feeds.MISFITS), missing_ok=True)
        assert [r["line"] for r in aside.collect()] == ["x"] * misfit


def test_a_batch_tag_needs_a_query(spark):
    with pytest.raises(RuntimeError, match="streaming query"):
        batch_tag(spark.range(1), 0)


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_a_file_ten_days_older_than_the_newest_arrives(spark, lake, kind):
    folder = f"{lake.root}/late"
    seen = []
    for i, age in enumerate((0, 6, 10, 0)):
        getattr(spark.createDataFrame([(i,)], "n int").write.mode("append"), kind)(folder, **({"header": True} if kind == "csv" else {}))
        for name in glob.glob(f"{folder}/part-*"):
            if name not in seen:
                os.utime(name, (time.time() - age * 86400,) * 2)
                seen.append(name)
        schema = StructType().add("n", "integer")
        stream = stream_feed(spark, folder, schema) if kind == "csv" else stream_table(spark, folder, schema)
        drain_to_table(stream, f"{lake.root}/taken", [], lake.checkpoint("late"))
        assert spark.read.parquet(f"{lake.root}/taken").count() == i + 1


def test_one_corrected_bar_recomputes_its_symbol_alone(spark, lake):
    key = "silver.daily_price_aggregates"
    target, path = lake.target(key), lake.path(key)
    one = daily(spark, 60)
    bars = one.unionByName(one.withColumn("symbol", F.lit("B")))
    upsert(bars, target)
    first = spark.read.parquet(feed_path(path)).count()
    upsert(bars.withColumn("avg_price", F.when(F.expr("symbol = 'B' AND date = '2024-02-10'"), 1.0).otherwise(F.col("avg_price"))), target)
    assert first == 120 and spark.read.parquet(feed_path(path)).count() == 121
    gold.roll_indicators(spark, lake, order="oldest_first")
    upsert(bars, target)
    newest = spark.read.parquet(feed_path(path)).groupBy("batch_tag").count().filter("count = 1").count()
    assert newest == 2
    wanted = refreshed_indicators(spark.createDataFrame([("B", date(2024, 2, 10))], "symbol string, date date"), read_target(spark, target), stored(spark, lake, "gold.daily_price_indicators"), order="oldest_first")
    assert {r["symbol"] for r in wanted.collect()} == {"B"} and wanted.count() == 20


def test_batches_of_different_runs_have_different_tags(spark, lake):
    deliver(prices(spark, [("A", 1.0, NOON)]), lake, "bronze.prices")
    for env in ("x", "y"):
        # Same table, another checkpoint: a full rerun.
        run = Lakehouse(lake.root, lake.env)
        object.__setattr__(run, "checkpoint", lambda stream, env=env: f"{lake.root}/{env}/{stream}")
        silver.refine_prices(spark, run, symbols(spark, "A"), gate="log", as_of=NOON)
    tags = [r["batch_tag"] for r in spark.read.parquet(lake.path("silver.prices")).collect()]
    assert len(set(tags)) == 2
    for tag in tags:
        uuid.UUID(tag[:36])


def bars_by_key(df):
    return {(r["symbol"], r["date"]): (r["avg_price"], r["volume"]) for r in df.collect()}


@pytest.mark.parametrize("windowed", [False, True])
def test_streamed_bars_equal_the_batch_and_grow_over_deliveries(spark, lake, windowed):
    drops = [
        [("A", 1.0, NOON), ("B", 4.0, NOON)],
        [("A", 3.0, NOON + timedelta(hours=1)), ("A", 8.0, NOON + timedelta(days=1))],
        [],
    ]
    for drop in drops:
        deliver(prices(spark, drop), lake, "silver.prices")
        silver.roll_daily_bars(spark, lake, windowed=windowed)
    got = bars_by_key(stored(spark, lake, "silver.daily_price_aggregates"))
    assert got == bars_by_key(daily_bars(prices(spark, sum(drops, []))))
    assert got["A", date(2024, 1, 10)] == (2.0, 30.0)


@pytest.mark.parametrize(("windowed", "price"), [(False, 2.0), (True, 1.0)])
def test_late_rows_reach_only_the_unbounded_bars(spark, lake, windowed, price):
    for s, p, t in (("A", 1.0, NOON), ("A", 5.0, NOON + timedelta(days=40)), ("A", 3.0, NOON)):
        deliver(prices(spark, [(s, p, t)]), lake, "silver.prices")
        silver.roll_daily_bars(spark, lake, windowed=windowed)
    bars = bars_by_key(stored(spark, lake, "silver.daily_price_aggregates"))
    assert bars["A", date(2024, 1, 10)][0] == price


def daily(spark, n, skip=()):
    start = date(2024, 1, 1)
    rows = []
    for i in range(n):
        if i not in skip:
            d, p = start + timedelta(days=i), float(50 + (i * 17) % 23)
            rows.append(("A", d, p, p, p, p, 10.0 * i, d.year, d.month))
    return spark.createDataFrame(rows, TABLES["silver.daily_price_aggregates"].schema)


def assert_close(left, right):
    a = sorted(map(tuple, left.collect()), key=lambda r: r[:2])
    b = sorted(map(tuple, right.collect()), key=lambda r: r[:2])
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == tuple(pytest.approx(v, abs=1e-9) if isinstance(v, float) else v for v in y)


def test_streamed_indicators_equal_the_batch_also_after_a_correction(spark, lake):
    key = "silver.daily_price_aggregates"
    target = lake.target(key)
    bars = daily(spark, 100, skip=range(40, 48))
    upsert(bars.filter("date < '2024-03-01'"), target)
    gold.roll_indicators(spark, lake, order="oldest_first")
    upsert(bars, target)
    gold.roll_indicators(spark, lake, order="oldest_first")
    gold.roll_indicators(spark, lake, order="oldest_first")
    wanted = indicators.daily_indicators(bars, order="oldest_first")
    assert_close(stored(spark, lake, "gold.daily_price_indicators"), wanted)
    corrected = bars.filter("date = '2024-02-03'").withColumn("avg_price", F.lit(400.0))
    upsert(corrected, target)
    gold.roll_indicators(spark, lake, order="oldest_first")
    wanted = indicators.daily_indicators(read_target(spark, target), order="oldest_first")
    assert_close(stored(spark, lake, "gold.daily_price_indicators"), wanted)


def test_set_up_is_repeatable_and_shows_written_rows(spark, lake):
    lake = Lakehouse(lake.root, env=f"e{uuid.uuid4().hex}")
    set_up(spark, lake)
    set_up(spark, lake)
    land(fetched(spark, "A"), lake, "pric", F.lit(NOON).cast("timestamp"))
    bronze.ingest_prices(spark, lake)
    refresh_partitions(spark, lake, "bronze.prices")
    table = spark.table(lake.table("bronze.prices"))
    assert set(PRICE_FEED.names) <= set(table.columns) and table.count() == 1
    assert spark.table(lake.table("logging.dq_log")).columns[: len(DQ_LOG.names) - 3] == DQ_LOG.names[:-3]
    assert select_all(spark, lake.table("bronze.prices")).count() == 1
    seen = []
    stream = stream_catalog_table(spark, lake.table("bronze.prices"))
    drain_batches(stream, lambda batch, _: seen.append(batch.count()), lake.checkpoint("seen"))
    assert sum(seen) == 1
