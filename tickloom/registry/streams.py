"""Streaming queries: each drains two deliveries into a table and returns the table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.config import Lakehouse
from tickloom.registry import views
from tickloom.registry.batch import CHECKED_AT, Query, fresh_lake
from tickloom.registry.views import rounded, table, view
from tickloom.schemas import FUNDAMENTALS_FEED, PRICE_FEED, SILVER_PRICES, TABLES
from tickloom.operators.cleaning import cast_ints
from tickloom.operators.upsert import upsert
from tickloom.sinks.catalog import read_target
from tickloom.sinks.files import append_table, land_history, write_batch
from tickloom.sources.feeds import MISFITS
from tickloom.sources.inventory import list_files
from tickloom.sources.tables import read_table
from tickloom.streaming import bronze, gold, silver

# The first delivery ends within a day, so one day's rows come in both.
_CUT = "extract_time < TIMESTAMP '2024-01-16 12:00:00'"
_FUND_CUT = "TIMESTAMP '1998-07-01'"


def _store(rows: DataFrame, lake: Lakehouse, key: str) -> None:
    spec, path = TABLES[key], lake.path(key)
    if spec.tagged:
        write_batch(rows, path, spec.partition_by, f"load-{uuid.uuid4().hex}")
    else:
        append_table(rows, path, spec.partition_by)


def _stored(spark: SparkSession, lake: Lakehouse, key: str) -> DataFrame:
    if TABLES[key].versioned:
        return read_target(spark, lake.target(key))
    return read_table(spark, lake.path(key), TABLES[key].schema)


def _make_old(spark: SparkSession, folder: str, old: bool) -> None:
    """Give the files that aren't dated back yet times of now, or of ten days ago."""
    jvm = spark.sparkContext._jvm
    files = [r["path"] for r in list_files(spark, folder).select("path").collect()]
    fs = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in files if old else []:
        path = jvm.org.apache.hadoop.fs.Path(name)
        fs.setTimes(path, fs.getFileStatus(path).getModificationTime() - 10 * 86_400_000, -1)


def stream_prices_ingest(spark: SparkSession, sf: str) -> DataFrame:
    lake = fresh_lake(spark, "prices")
    ticks = view(spark, sf, views.TICKS).select(*PRICE_FEED.names)
    for part in (_CUT, f"NOT {_CUT}"):
        land_history(ticks.filter(part), lake.landing(lake.price_feed))
        _make_old(spark, lake.landing(lake.price_feed), part != _CUT)
        bronze.ingest_prices(spark, lake, max_files=40)
    return rounded(_stored(spark, lake, "bronze.prices"))


def stream_fundamentals_ingest(spark: SparkSession, sf: str) -> DataFrame:
    lake = fresh_lake(spark, "fundamentals")
    rows = view(spark, sf, views.FUNDAMENTALS).select(*FUNDAMENTALS_FEED.names)
    cut = f"extract_time < {_FUND_CUT}"
    for part in (cut, f"NOT {cut}"):
        land_history(rows.filter(part), lake.landing(lake.fundamentals_feed))
        _make_old(spark, lake.landing(lake.fundamentals_feed), part != cut)
        bronze.ingest_fundamentals(spark, lake)
    return rounded(_stored(spark, lake, "bronze.fundamentals"))


def stream_misfits(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks of which some have no number as volume, then files with two columns swapped: what became of each."""
    lake = fresh_lake(spark, "misfits")
    ticks = view(spark, sf, views.TICKS).select(*PRICE_FEED.names)
    text = F.when(F.col("volume") % 50 == 0, "n/a").otherwise(F.col("volume").cast("string"))
    swapped = ["symbol", "open", "current_price", *PRICE_FEED.names[3:]]
    for rows in (ticks.filter(_CUT).withColumn("volume", text), ticks.filter(f"NOT {_CUT}").select(*swapped)):
        land_history(rows, lake.landing(lake.price_feed))
        bronze.ingest_prices(spark, lake)
    kept = _stored(spark, lake, "bronze.prices").select(F.lit("kept").alias("fate"), "symbol", "day")
    aside = read_table(spark, bronze.misfits_path(lake.path("bronze.prices")), StructType.fromDDL(MISFITS))
    values = F.split("line", ",")
    aside = aside.filter(values[0] != "symbol")  # the headers of the swapped files
    day = F.element_at(values, -1).try_cast("int")
    aside = aside.select(F.col("reason").alias("fate"), values[0].alias("symbol"), day.alias("day"))
    return kept.unionByName(aside).groupBy("fate", "symbol", "day").agg(F.count("*").alias("n"))


def stream_silver_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Single ticks are no complete snapshots, so the gate only logs."""
    lake = fresh_lake(spark, "silver")
    rows = view(spark, sf, views.DELIVERIES)
    symbols = table(spark, sf, "events").selectExpr("event_type AS symbol").distinct()
    for part in (_CUT, f"NOT {_CUT}"):
        _store(rows.filter(part), lake, "bronze.prices")
        silver.refine_prices(spark, lake, symbols, gate="log", as_of=CHECKED_AT)
    return rounded(_stored(spark, lake, "silver.prices"))


def stream_fundamentals_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The second delivery repeats the last month of the first."""
    lake = fresh_lake(spark, "dedup")
    rows = view(spark, sf, views.FUNDAMENTALS)
    for part in (f"extract_time < {_FUND_CUT}", f"extract_time >= {_FUND_CUT} - INTERVAL 1 MONTH"):
        _store(rows.filter(part), lake, "bronze.fundamentals")
        silver.refine_fundamentals(spark, lake)
    return rounded(_stored(spark, lake, "silver.fundamentals"))


def _daily_bars(windowed: bool) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        lake = fresh_lake(spark, "bars")
        prices = cast_ints(view(spark, sf, views.TICKS), ["market_cap"]).select(*SILVER_PRICES.names)
        for part in (_CUT, f"NOT {_CUT}"):
            _store(prices.filter(part), lake, "silver.prices")
            silver.roll_daily_bars(spark, lake, windowed=windowed)
        return rounded(_stored(spark, lake, "silver.daily_price_aggregates"), 8)

    return query


def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks through silver to bars, with the first batch of bronze written again between two runs."""
    lake = fresh_lake(spark, "replay")
    ticks, spec = view(spark, sf, views.TICKS), TABLES["bronze.prices"]
    symbols = table(spark, sf, "events").selectExpr("event_type AS symbol").distinct()
    parts = {"q-0": _CUT, "q-1": f"NOT {_CUT}"}
    for tags in (["q-0"], ["q-0", "q-1"]):
        for tag in tags:
            write_batch(ticks.filter(parts[tag]), lake.path("bronze.prices"), spec.partition_by, tag)
        silver.refine_prices(spark, lake, symbols, gate="log", as_of=CHECKED_AT)
        silver.roll_daily_bars(spark, lake)
    return rounded(_stored(spark, lake, "silver.daily_price_aggregates"), 8)


def stream_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Bars in two deliveries, of which the first has wrong prices on one day that are corrected at last."""
    lake = fresh_lake(spark, "indicators")
    key, wrong = "silver.daily_price_aggregates", F.col("date") == F.lit("1999-06-15").cast("date")
    bars = view(spark, sf, views.BARS)
    first = bars.filter("date < DATE '2000-03-15'").withColumn("avg_price", F.when(wrong, F.col("avg_price") * 3).otherwise(F.col("avg_price")))
    for rows in (first, bars.filter("date >= DATE '2000-03-15'"), bars.filter(wrong)):
        upsert(rows, lake.target(key))
        gold.roll_indicators(spark, lake)
    return rounded(_stored(spark, lake, "gold.daily_price_indicators"), 4)


QUERIES: dict[str, Query] = {
    "stream_prices_ingest": stream_prices_ingest,
    "stream_fundamentals_ingest": stream_fundamentals_ingest,
    "stream_misfits": stream_misfits,
    "stream_silver_prices": stream_silver_prices,
    "stream_fundamentals_dedup": stream_fundamentals_dedup,
    "stream_daily_bars": _daily_bars(windowed=False),
    "stream_daily_bars_windowed": _daily_bars(windowed=True),
    "stream_replay": stream_replay,
    "stream_indicators": stream_indicators,
}
