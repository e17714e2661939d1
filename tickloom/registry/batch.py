"""Batch queries: one per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import Lakehouse, shared_folder
from tickloom.functions import buckets
from tickloom.functions.times import extract_hour, months_back
from tickloom.operators import bars as bar_ops
from tickloom.operators import cleaning, history, indicators, quality
from tickloom.operators.upsert import upsert
from tickloom.plans.landing import land
from tickloom.plans.setup import refresh_partitions, set_up
from tickloom.registry import views
from tickloom.registry.views import rounded, table, view
from tickloom.schemas import PRICE_FEED, TABLES
from tickloom.sinks.catalog import read_target
from tickloom.sinks.files import land_history, max_partition, preview, write_batch
from tickloom.sources.feeds import read_feed, read_untyped
from tickloom.sources.inventory import list_files
from tickloom.sources.symbols import read_symbol_column, read_symbols
from tickloom.sources.tables import read_table, select_all

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(1998, 6, 15)
CHECKED_AT = datetime(2024, 1, 15, 10, 0, 0)


def _ticks(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, views.TICKS)


def _bars(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, views.BARS)


def fresh_lake(spark: SparkSession, purpose: str) -> Lakehouse:
    """A lakehouse of its own folder and databases."""
    root = shared_folder(spark, purpose)
    return Lakehouse(root, env=f"t{root.rsplit('-', 1)[-1]}")


# Sources and sinks


def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{sf}/orders.parquet"
    return read_table(spark, path, spark.read.parquet(path).schema)


def sql_select_all(spark: SparkSession, sf: str) -> DataFrame:
    _ticks(spark, sf).createOrReplaceTempView("tickloom_ticks")
    return rounded(select_all(spark, "tickloom_ticks"))


def csv_untyped_read(spark: SparkSession, sf: str) -> DataFrame:
    folder = fresh_lake(spark, "untyped").landing("hourly_prices")
    land_history(_ticks(spark, sf), folder)
    untyped = read_untyped(spark, folder)
    # The texts of doubles differ between engines; their values must not.
    amounts = [f.name for f in PRICE_FEED.fields if f.dataType.simpleString() == "double"]
    return rounded(untyped.select(*[F.col(c).cast("double") if c in amounts else F.col(c) for c in PRICE_FEED.names]))


def symbol_list(spark: SparkSession, sf: str) -> DataFrame:
    """Both readers over one list with padded, repeated and blank lines."""
    folder = f"{shared_folder(spark, 'symbols')}/list"
    names = view(spark, sf, views.COMPANIES).select("symbol", "sector")
    lines = names.select(F.concat("symbol", F.lit(" ")).alias("value"))
    lines = lines.unionAll(names.select("sector")).unionAll(names.select(F.lit("")))
    lines.write.text(folder)
    trimmed = read_symbols(spark, folder).withColumn("reader", F.lit("lines"))
    return trimmed.unionByName(read_symbol_column(spark, folder).withColumn("reader", F.lit("column")))


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    lake = fresh_lake(spark, "roundtrip")
    fetched = view(spark, sf, views.FETCHED)
    land(fetched, lake, "pric", F.col("taken_at"))
    return rounded(read_feed(spark, lake.landing(lake.price_feed), PRICE_FEED))


def preview_limit(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(preview(_ticks(spark, sf), ["extract_time", "symbol", "current_price", "volume"]))


def file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    folder = fresh_lake(spark, "inventory").landing("bars")
    land_history(_bars(spark, sf), folder)
    read = read_untyped(spark, folder).groupBy(F.col("_metadata.file_path").alias("read_path"), F.col("_metadata.file_size").alias("size"))
    read = read.agg(F.count(F.lit(1)).alias("rows"))
    listed = list_files(spark, folder).join(read, F.col("path") == F.col("read_path"), "outer")
    named = listed.withColumn("folder", F.regexp_extract("path", "(feed_year=[^/]*/feed_month=[^/]*)/[^/]*[.]csv$", 1))
    return named.groupBy("folder").agg(
        F.sum("rows").alias("rows"),
        F.bool_and(F.col("path").isNotNull() & F.col("read_path").isNotNull()).alias("all_listed"),
        F.bool_and(F.col("length") == F.col("size")).alias("lengths_agree"),
    )


def ddl_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Set up all tables, fill two of them, and read those through the catalog."""
    lake = fresh_lake(spark, "catalog")
    set_up(spark, lake)
    prices, bars = "bronze.prices", "silver.daily_price_aggregates"
    write_batch(_ticks(spark, sf), lake.path(prices), TABLES[prices].partition_by, "load-1")
    refresh_partitions(spark, lake, prices)
    upsert(_bars(spark, sf), lake.target(bars))
    counts = []
    for key in (prices, bars):
        per_month = spark.table(lake.table(key)).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))
        counts.append(per_month.withColumn("table_name", F.lit(key)))
    return history.union_by_name(counts)


# Cleaning


def filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.filter_not_null(view(spark, sf, views.DOC_LABELS), ["quality", "toxic"])


def cast_ints(spark: SparkSession, sf: str) -> DataFrame:
    amounts = table(spark, sf, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") * 1e9).alias("amount"),
        F.col("c_acctbal").cast("string").alias("amount_text"),
        F.col("c_custkey").cast("string").alias("whole_text"),
        F.col("c_name").alias("no_amount"),
    )
    return cleaning.cast_ints(amounts, ["amount", "amount_text", "whole_text", "no_amount"])


def _category(column: str, category: Callable[[], F.Column], name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        companies = view(spark, sf, views.COMPANIES)
        return companies.select("symbol", column, category().alias(name))

    return query


def add_prev_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.add_prev_prefix(_bars(spark, sf)))


def order_columns(spark: SparkSession, sf: str) -> DataFrame:
    shuffled = view(spark, sf, views.FUNDAMENTALS).withColumn("unlisted", F.col("country"))
    return rounded(cleaning.order_columns(shuffled.select(*sorted(shuffled.columns))))


def normalize_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.normalize_snapshot(view(spark, sf, views.FETCHED)))


def stamp_partitions(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    stamped = cleaning.stamp_partitions(orders, F.col("o_orderdate"), shift_days=2)
    return stamped.drop("o_orderdate")


def drop_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def clean_prices(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.clean_prices(view(spark, sf, views.DELIVERIES)))


def clean_fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.clean_fundamentals(view(spark, sf, views.FUNDAMENTALS)))


# Scalars


def extract_hours(spark: SparkSession, sf: str) -> DataFrame:
    return _ticks(spark, sf).select("symbol", "extract_time", extract_hour().alias("extract_hour"))


def month_pairs(spark: SparkSession, sf: str) -> DataFrame:
    months = history.distinct_dates(_bars(spark, sf)).select("date", F.explode(months_back("date", 90)).alias("m"))
    return months.select("date", F.year("m").alias("year"), F.month("m").alias("month"))


# History


def history_slice(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(history.history_slice(_bars(spark, sf), AS_OF))


def latest_row(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(history.latest_row(_bars(spark, sf), AS_OF))


def _hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Newest tick of each symbol and hour."""
    ticks = _ticks(spark, sf).withColumn("hour", F.date_trunc("hour", "extract_time"))
    newest = ticks.groupBy("symbol", "hour").agg(F.max(F.struct("extract_time", "current_price", "volume", "year", "month")).alias("t"))
    return newest.select("symbol", F.col("hour").alias("hour_start"), "t.current_price", "t.volume", "t.year", "t.month")


def history_slice_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(history.history_slice(_hourly(spark, sf), CHECKED_AT.date(), 7, "hour_start"))


def latest_row_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(history.latest_row(_hourly(spark, sf), CHECKED_AT.date(), 3, "hour_start"))


def price_diff(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(history.price_diff(_bars(spark, sf)).select("symbol", "date", "price_diff"))


def obv_running(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(history.obv_running(_bars(spark, sf)).select("symbol", "date", "obv_change", "obv"))


def join_prev_state(spark: SparkSession, sf: str) -> DataFrame:
    bars = _bars(spark, sf)
    state = cleaning.add_prev_prefix(history.newest_per_symbol(bars))
    joined = history.join_prev_state(bars, state)
    return rounded(joined.select("symbol", "date", "avg_price", "prev_date", "prev_avg_price"))


def outer_join_fold(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("symbol", F.concat(F.lit("C"), "o_custkey"))
    frames = [
        orders.filter(F.col("o_orderstatus") == status)
        .groupBy("symbol")
        .agg(F.max("o_totalprice").alias(f"best_{status.lower()}"))
        for status in ("F", "O", "P")
    ]
    return history.outer_join_fold(frames)


def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    bars, ticks = _bars(spark, sf), bar_ops.daily_bars(_ticks(spark, sf))
    return rounded(history.union_by_name([bars, ticks.select(*sorted(ticks.columns))]), 8)


def distinct_dates(spark: SparkSession, sf: str) -> DataFrame:
    return history.distinct_dates(_bars(spark, sf))


def max_partition_values(spark: SparkSession, sf: str) -> DataFrame:
    return max_partition(_bars(spark, sf))


# Bars and indicators


def daily_bars(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(bar_ops.daily_bars(_ticks(spark, sf)), 8)


def _indicator(build: Callable[..., DataFrame], *columns: str, **options: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(build(_bars(spark, sf), **options).select("symbol", "date", *columns), 4)

    return query


def _each(*kinds: str) -> list[str]:
    return [f"{kind}_{n}" for n in (12, 26, 60) for kind in kinds]


def daily_indicators(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(indicators.daily_indicators(_bars(spark, sf)), 4)


# Checks


def _ctx(table_path: str) -> quality.LogContext:
    return quality.LogContext(table_path, "Silver", CHECKED_AT, "b1")


def _log(log: DataFrame) -> DataFrame:
    return log.drop("_check")


def dq_null(spark: SparkSession, sf: str) -> DataFrame:
    check = quality.NullCheck(["doc_id", "quality", "toxic"])
    return _log(quality.evaluate(view(spark, sf, views.DOC_LABELS), [check], _ctx("doc_labels")))


def dq_message_format(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of every kind of check on one table."""
    checks = [
        quality.NullCheck(["quality"]),
        quality.NonNegativeCheck(["toxic"]),
        quality.RowCountCheck(0),
        quality.UniquenessCheck(["lang", "quality"]),
    ]
    log = quality.evaluate(view(spark, sf, views.DOC_LABELS), checks, _ctx("doc_labels"))
    return log.select("check_name", "expected_value", "observed_value", "status", "error_message")


def dq_non_negative(spark: SparkSession, sf: str) -> DataFrame:
    check = quality.NonNegativeCheck(["c_acctbal", "c_custkey"])
    return _log(quality.evaluate(table(spark, sf, "customer"), [check], _ctx("customer")))


def _symbols(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_type").alias("symbol"))


def expected_rows(spark: SparkSession, sf: str) -> DataFrame:
    hourly = _ticks(spark, sf).withColumn("extract_time", F.date_trunc("hour", "extract_time"))
    return quality.expected_rows(hourly, _symbols(spark, sf))


def dq_row_count(spark: SparkSession, sf: str) -> DataFrame:
    hourly = _ticks(spark, sf).withColumn("extract_time", F.date_trunc("hour", "extract_time"))
    check = quality.RowCountCheck(quality.expected_rows(hourly, _symbols(spark, sf)).scalar())
    return _log(quality.evaluate(hourly, [check], _ctx("ticks")))


def _unique(count: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        check = quality.UniquenessCheck(["l_orderkey", "l_linenumber"], count)
        return _log(quality.evaluate(table(spark, sf, "lineitem"), [check], _ctx("lineitem")))

    return query


def _duplicate_files(scope: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        # Every third tick is a month older; every fifth was filed under another year when it came.
        at = F.when(F.col("volume") % 3 == 0, F.col("extract_time") - F.expr("INTERVAL 31 DAYS")).otherwise(F.col("extract_time"))
        ticks = _ticks(spark, sf).withColumn("extract_time", at)
        ticks = ticks.withColumns({"year": F.year("extract_time"), "month": F.month("extract_time"), "day": F.dayofmonth("extract_time")})
        half = F.minute("extract_time") >= 30
        bronze = ticks.filter(~half).withColumn("year", F.when(F.col("volume") % 5 == 0, 2020).otherwise(F.col("year")))
        return _log(quality.duplicate_delivery_check(ticks.filter(half), bronze, _ctx("bronze.prices"), scope))

    return query


def dq_gate_prices(spark: SparkSession, sf: str) -> DataFrame:
    prices = view(spark, sf, views.DELIVERIES)
    checks = quality.price_gate(prices, _symbols(spark, sf))
    return _log(quality.evaluate(prices, checks, _ctx("silver.prices")))


def dq_file_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """A feed landed just now, checked in the hour of its newest file, in another hour, and for another month."""
    lake = fresh_lake(spark, "arrival")
    land(view(spark, sf, views.FETCHED), lake, "pric", F.current_timestamp())
    folder = lake.landing(lake.price_feed)
    came = list_files(spark, folder).agg(F.max("modificationTime")).first()[0]
    later = came + timedelta(hours=2)
    other = later if later.month == came.month else came - timedelta(hours=2)
    cases = {"found": came, "too_old": other, "missing": came.replace(year=2001, day=1)}
    logs = []
    for case, as_of in cases.items():
        log = quality.file_arrival_check(spark, quality.LogContext(folder, "Bronze", as_of), "folder")
        seen = F.when(F.col("observed_value").isin("Found", "Missing"), F.col("observed_value")).otherwise("a time")
        said = F.regexp_extract("error_message", "^(No files found|Latest file|)", 1)
        logs.append(log.select(F.lit(case).alias("case"), "check_name", "check_type", "layer", "status", seen.alias("observed"), said.alias("said")))
    return history.union_by_name(logs)


def dq_log_append(spark: SparkSession, sf: str) -> DataFrame:
    """The log of two runs, the first of them retried, as it is read back."""
    path = fresh_lake(spark, "log").path("logging.dq_log")
    labels, customers = view(spark, sf, views.DOC_LABELS), table(spark, sf, "customer")
    nulls = quality.evaluate(labels, [quality.NullCheck(["doc_id", "quality", "toxic"])], _ctx("doc_labels"))
    signs = quality.evaluate(customers, [quality.NonNegativeCheck(["c_acctbal", "c_custkey"])], _ctx("customer"))
    for log, tag in ((nulls, "run-1"), (nulls, "run-1"), (signs, "run-2")):
        quality.enforce(log, path, critical=False, tag=tag)
    return read_table(spark, path, TABLES["logging.dq_log"].schema)


def dq_log_retry(spark: SparkSession, sf: str) -> DataFrame:
    """The log of a batch that fails its checks, is repaired and then passes: it tells of the last attempt."""
    path = fresh_lake(spark, "log").path("logging.dq_log")
    labels = view(spark, sf, views.DOC_LABELS)
    checks = [quality.NullCheck(["doc_id", "quality", "toxic"])]
    for rows in (labels, labels.dropna(subset=["quality", "toxic"])):
        quality.enforce(quality.evaluate(rows, checks, _ctx("doc_labels")), path, critical=False, tag="run-1")
    return read_table(spark, path, TABLES["logging.dq_log"].schema)


# Upserts


def upsert_daily_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of a first part of the ticks, then all bars from a week before its end on."""
    target = fresh_lake(spark, "bars").target("silver.daily_price_aggregates")
    ticks = _ticks(spark, sf)
    upsert(bar_ops.daily_bars(ticks.filter("extract_time < TIMESTAMP '2024-01-20 12:00:00'")), target)
    changes = bar_ops.daily_bars(ticks).filter("date >= DATE '2024-01-13'")
    upsert(changes, target, ("open", "day_high", "day_low", "avg_price", "volume"))
    return rounded(read_target(spark, target), 8)


def upsert_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rows with an outdated column, then the right rows for the later part."""
    target = fresh_lake(spark, "indicators").target("gold.daily_price_indicators")
    right = indicators.daily_indicators(_bars(spark, sf))
    outdated = right.filter("date < DATE '2000-01-01'").withColumn("ma_12", F.col("ma_12") + 1000)
    upsert(outdated, target)
    upsert(right.filter("date >= DATE '1998-01-01'"), target)
    return rounded(read_target(spark, target), 4)


QUERIES: dict[str, Query] = {
    "scan_table": scan_table,
    "sql_select_all": sql_select_all,
    "csv_untyped_read": csv_untyped_read,
    "symbol_list": symbol_list,
    "csv_roundtrip": csv_roundtrip,
    "preview_limit": preview_limit,
    "file_inventory": file_inventory,
    "ddl_catalog": ddl_catalog,
    "filter_not_null": filter_not_null,
    "cast_ints": cast_ints,
    "bucket_market_cap": _category("marketCap", buckets.market_cap_category, "marketCapCategory"),
    "bucket_employees": _category(
        "fullTimeEmployees", buckets.employee_category, "employeeCountCategory"
    ),
    "bucket_margin": _category("profitMargins", buckets.margin_category, "profitMarginCategory"),
    "bucket_growth": _category("revenueGrowth", buckets.growth_category, "revenueGrowthCategory"),
    "add_prev_prefix": add_prev_prefix,
    "order_columns": order_columns,
    "normalize_snapshot": normalize_snapshot,
    "stamp_partitions": stamp_partitions,
    "drop_duplicates": drop_duplicates,
    "clean_prices": clean_prices,
    "clean_fundamentals": clean_fundamentals,
    "extract_hour": extract_hours,
    "month_pairs": month_pairs,
    "history_slice": history_slice,
    "latest_row": latest_row,
    "history_slice_hourly": history_slice_hourly,
    "latest_row_hourly": latest_row_hourly,
    "price_diff": price_diff,
    "obv_running": obv_running,
    "join_prev_state": join_prev_state,
    "outer_join_fold": outer_join_fold,
    "union_by_name": union_by_name,
    "distinct_dates": distinct_dates,
    "max_partition": max_partition_values,
    "daily_bars": daily_bars,
    "sma": _indicator(indicators.sma, *_each("ma")),
    "ema": _indicator(indicators.ema, *_each("ema")),
    "rsi_newest_first": _indicator(indicators.rsi, *_each("rsi"), order="newest_first"),
    "rsi_oldest_first": _indicator(indicators.rsi, *_each("rsi"), order="oldest_first"),
    "macd": _indicator(indicators.macd, "macd", "signal", "macd_hist"),
    "bollinger": _indicator(indicators.bollinger, *_each("bb_upper", "bb_lower", "bb_width")),
    "obv_newest_first": _indicator(indicators.obv, "obv", order="newest_first"),
    "obv_oldest_first": _indicator(indicators.obv, "obv", order="oldest_first"),
    "daily_indicators": daily_indicators,
    "dq_null": dq_null,
    "dq_non_negative": dq_non_negative,
    "dq_row_count": dq_row_count,
    "dq_unique_total": _unique("rows"),
    "dq_unique_groups": _unique("groups"),
    "dq_duplicate_files_month": _duplicate_files("month"),
    "dq_duplicate_files_days": _duplicate_files("days"),
    "dq_gate_prices": dq_gate_prices,
    "dq_file_arrival": dq_file_arrival,
    "dq_log_append": dq_log_append,
    "dq_log_retry": dq_log_retry,
    "dq_message_format": dq_message_format,
    "expected_rows": expected_rows,
    "upsert_daily_bars": upsert_daily_bars,
    "upsert_indicators": upsert_indicators,
}
