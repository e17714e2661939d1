"""Daily bars to the indicator table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import Lakehouse
from tickloom.operators.indicators import WINDOWS
from tickloom.operators.upsert import feed_path, upsert
from tickloom.plans.gold import refreshed_indicators
from tickloom.sinks.catalog import read_target
from tickloom.sinks.files import batch_tag, drain_batches
from tickloom.sources.tables import stream_table


def roll_indicators(
    spark: SparkSession,
    lake: Lakehouse,
    windows: Sequence[int] = WINDOWS,
    order: str = "newest_first",
    refresh: str = "following",
    max_files: int | None = None,
) -> StreamingQuery:
    """Recompute and store the indicators of bars that changed, all dates of a batch in one job.

    The source is the change feed of the bars: one corrected bar recomputes its symbol alone.
    """
    bars, gold = lake.target("silver.daily_price_aggregates"), lake.target("gold.daily_price_indicators")

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        changed = batch.select("symbol", "date").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stored, known = read_target(session, bars), read_target(session, gold)
            fresh = refreshed_indicators(changed, stored, known, windows, order, refresh)
            if fresh is not None:
                upsert(fresh, gold, tag=batch_tag(batch, batch_id))
        finally:
            changed.unpersist()

    stream = stream_table(spark, feed_path(bars.path), bars.spec.feed_schema, max_files)
    return drain_batches(stream, store, lake.checkpoint("gold_indicators"), mode="update")
