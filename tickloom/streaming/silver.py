"""Bronze tables to checked and cleaned silver tables, and silver prices to daily bars."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import Lakehouse
from tickloom.operators.bars import MERGED, daily_bars_windowed, partial_bars
from tickloom.operators.cleaning import add_categories, cast_ints, clean_prices, filter_not_null
from tickloom.operators.quality import LogContext, enforce, evaluate, price_gate
from tickloom.operators.upsert import upsert
from tickloom.schemas import FUNDAMENTALS_AMOUNTS, FUNDAMENTALS_KEY, TABLES
from tickloom.sinks.files import batch_tag, committed, drain_batches, drain_to_table, write_batch
from tickloom.sources.tables import stream_table

PRICE_DELAY = "2 days"
BAR_DELAY = "5 days"
BAR_UPDATES = ("open", "day_high", "day_low", "avg_price", "volume")

GATE_MODES = ("raise", "quarantine", "log")


def refine_prices(
    spark: SparkSession,
    lake: Lakehouse,
    symbols: DataFrame,
    gate: str = "raise",
    as_of: datetime | None = None,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> StreamingQuery:
    """Gate, clean and append new bronze prices, one micro-batch at a time.

    A batch that fails the gate stops the stream (``raise``), goes to a folder beside the table
    (``quarantine``), or is only logged (``log``). Duplicates are removed within a batch, and the
    expected rows are counted per batch too: symbols times extraction times of that batch. A batch
    is read from its files for the gate and for the cleaning; nothing raw is persisted.
    """
    if gate not in GATE_MODES:
        raise ValueError(f"gate must be one of {GATE_MODES}, not {gate!r}")
    spec, path = TABLES["silver.prices"], lake.path("silver.prices")
    checkpoint = lake.checkpoint("silver_prices")

    def store(batch: DataFrame, batch_id: int) -> None:
        tag = batch_tag(batch, batch_id)
        if any(committed(batch.sparkSession, p, tag) for p in (path, f"{path}_quarantine")):
            return  # a replay; its log tells of the attempt that was stored
        ctx = LogContext(path, "Silver", as_of or datetime.now(timezone.utc), tag)
        if batch.isEmpty():
            return
        log = evaluate(batch, price_gate(batch, symbols), ctx)
        passed = enforce(log, lake.path("logging.dq_log"), critical=gate == "raise", tag=tag)
        if passed or gate == "log":
            write_batch(clean_prices(batch).select(*spec.schema.names), path, spec.partition_by, tag)
        else:
            write_batch(batch, f"{path}_quarantine", spec.partition_by, tag)

    bronze = TABLES["bronze.prices"].schema
    stream = stream_table(spark, lake.path("bronze.prices"), bronze, max_files, max_bytes)
    return drain_batches(stream.withWatermark("extract_time", PRICE_DELAY), store, checkpoint)


def unique_so_far(rows: DataFrame, keys: Sequence[str], spread: bool = True) -> DataFrame:
    """First row of each key of a stream; a key is remembered until the watermark passes it.

    The first copy to arrive stays. With ``spread``, copies are thinned out per input task first, so
    that a key that comes very often sends one row per input task to the place where it is decided;
    without it all copies of a key meet in one task.
    """
    if spread:
        placed = rows.withColumn("_task", F.spark_partition_id())
        rows = placed.dropDuplicates([*keys, "_task"]).drop("_task")
    return rows.dropDuplicates(list(keys))


def refine_fundamentals(
    spark: SparkSession,
    lake: Lakehouse,
    spread: bool = True,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> StreamingQuery:
    """Clean, de-duplicate across batches, categorize and append new bronze fundamentals.

    Late rows, older than the watermark, are dropped.
    """
    spec = TABLES["silver.fundamentals"]
    bronze = TABLES["bronze.fundamentals"].schema
    rows = stream_table(spark, lake.path("bronze.fundamentals"), bronze, max_files, max_bytes)
    present = cast_ints(filter_not_null(rows, FUNDAMENTALS_KEY), FUNDAMENTALS_AMOUNTS)
    unique = unique_so_far(present.withWatermark("extract_time", PRICE_DELAY), FUNDAMENTALS_KEY, spread)
    return drain_to_table(
        add_categories(unique).select(*spec.schema.names),
        lake.path("silver.fundamentals"),
        spec.partition_by,
        lake.checkpoint("silver_fundamentals"),
    )


def roll_daily_bars(
    spark: SparkSession, lake: Lakehouse, windowed: bool = False, max_files: int | None = None
) -> StreamingQuery:
    """Keep the daily bars up to date from new silver prices.

    Each micro-batch is rolled up by itself, with the sum and number of its prices, and merged into the
    stored bars: late rows of any age arrive, and no state is kept besides the table. ``windowed`` is the
    form with a state, which drops rows older than the watermark and forgets finished days.
    """
    target = lake.target("silver.daily_price_aggregates")
    prices = stream_table(spark, lake.path("silver.prices"), TABLES["silver.prices"].schema, max_files)
    if windowed:

        def replace(batch: DataFrame, batch_id: int) -> None:
            upsert(batch, target, BAR_UPDATES, batch_tag(batch, batch_id))

        bars = daily_bars_windowed(prices.withWatermark("extract_time", BAR_DELAY))
        return drain_batches(bars, replace, lake.checkpoint("silver_dailyagg_windowed"), mode="update")

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert(partial_bars(batch), target, tag=batch_tag(batch, batch_id), combine=MERGED)

    return drain_batches(prices, merge, lake.checkpoint("silver_dailyagg"))
