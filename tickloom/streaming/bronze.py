"""Landed CSV files to bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import Lakehouse
from tickloom.schemas import TABLES, TableSpec
from tickloom.sinks.files import batch_tag, commit, committed, drain_batches, drain_to_table, write_batch
from tickloom.sources.feeds import fitted, stream_feed, stream_lines


def misfits_path(path: str) -> str:
    """Where lines that did not fit a table are set aside."""
    return f"{path}_misfits"


def store_fitting(lines: DataFrame, spec: TableSpec, path: str, tag: str) -> None:
    """Append the rows of a batch that fit the table, and set the other lines aside.

    The marker of the folder of misfits is the last step, also where there are none.
    """
    spark, aside = lines.sparkSession, misfits_path(path)
    if committed(spark, aside, tag):
        return
    rows, all_fit = fitted(lines, spec.schema)
    write_batch(rows.filter("reason IS NULL").select("row.*").select(*spec.schema.names), path, spec.partition_by, tag)
    if all_fit:
        commit(spark, aside, tag)
    else:
        write_batch(rows.filter("reason IS NOT NULL").select("source_file", "line", "reason"), aside, (), tag)


def _ingest(
    spark: SparkSession,
    lake: Lakehouse,
    feed: str,
    key: str,
    max_files: int | None,
    max_bytes: str | None,
    archive: str | None,
    strict: bool,
) -> StreamingQuery:
    spec, path, checkpoint = TABLES[key], lake.path(key), lake.checkpoint(f"bronze_{TABLES[key].name}")
    if not strict:
        stream = stream_feed(spark, lake.landing(feed), spec.schema, max_files, max_bytes, archive=archive)
        return drain_to_table(stream, path, spec.partition_by, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        store_fitting(batch, spec, path, batch_tag(batch, batch_id))

    stream = stream_lines(spark, lake.landing(feed), max_files, max_bytes, archive=archive)
    return drain_batches(stream, store, checkpoint)


def ingest_prices(
    spark: SparkSession,
    lake: Lakehouse,
    max_files: int | None = None,
    max_bytes: str | None = None,
    archive: str | None = None,
    strict: bool = True,
) -> StreamingQuery:
    """Append the price files that arrived since the last run, each exactly once.

    Files whose header isn't that of the feed and rows that don't parse are set aside beside the
    table. Without ``strict`` columns are taken by position, and what doesn't parse is NULL.
    """
    return _ingest(spark, lake, lake.price_feed, "bronze.prices", max_files, max_bytes, archive, strict)


def ingest_fundamentals(
    spark: SparkSession,
    lake: Lakehouse,
    max_files: int | None = None,
    max_bytes: str | None = None,
    archive: str | None = None,
    strict: bool = True,
) -> StreamingQuery:
    """Append the fundamentals files that arrived since the last run, each exactly once, like prices."""
    return _ingest(spark, lake, lake.fundamentals_feed, "bronze.fundamentals", max_files, max_bytes, archive, strict)
