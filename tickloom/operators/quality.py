"""Data-quality checks that write a log and stop the job.

A check is a small description. ``evaluate`` turns all checks on one table into log rows with
one aggregation for the row-wise counts and one per uniqueness key; nothing is collected.
``enforce`` appends the log rows and then raises for what failed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.partitions import touched_by
from tickloom.functions.times import extract_hour
from tickloom.schemas import BY_DAY, DQ_LOG, PRICE_KEY
from tickloom.sinks.files import replace_batch, write_batch
from tickloom.sources.inventory import list_files


class DataQualityError(ValueError):
    """At least one check failed; the log already says which."""


@dataclass(frozen=True)
class LogContext:
    """What every log row says about its run."""

    table_path: str
    layer: str
    as_of: datetime
    batch_id: str | None = None


@dataclass(frozen=True)
class NullCheck:
    columns: Sequence[str]


@dataclass(frozen=True)
class NonNegativeCheck:
    columns: Sequence[str]


@dataclass(frozen=True)
class RowCountCheck:
    """``expected`` is a number or a scalar column, such as ``expected_rows(...).scalar()``."""

    expected: int | Column


@dataclass(frozen=True)
class UniquenessCheck:
    """Counts surplus rows (``rows``) or keys that occur more than once (``groups``)."""

    columns: Sequence[str]
    count: str = "rows"


Check = NullCheck | NonNegativeCheck | RowCountCheck | UniquenessCheck


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _entry(
    name: str, kind: str, expected: Column, observed: Column, failed: Column, message: Column, check: int = 0
) -> Column:
    # A failing comparison with an unknown expectation must not pass as "no failure".
    ok = F.coalesce(~failed, F.lit(False))
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(kind).alias("check_type"),
        expected.alias("expected_value"),
        observed.alias("observed_value"),
        F.when(ok, "PASS").otherwise("FAIL").alias("status"),
        F.when(ok, "").otherwise(message).alias("error_message"),
        F.lit(check).alias("_check"),
    )


def _count_entry(name: str, expected: str, n: Column, unit: str, where: str, check: int) -> Column:
    observed = _text(n, f" {unit}")
    return _entry(name, "validation", F.lit(expected), observed, n > 0, _text(observed, where), check)


def _log_rows(measured: DataFrame, entries: Sequence[Column], ctx: LogContext) -> DataFrame:
    """One log row per entry of a one-row frame; ``_check`` tells which check an entry is of."""
    at = F.lit(ctx.as_of).cast("timestamp")
    rows = measured.select(F.inline(F.array(*entries)))
    return rows.select(
        F.lit(ctx.table_path).alias("table_path"),
        F.lit(ctx.layer).alias("layer"),
        F.lit(ctx.batch_id).cast("string").alias("batch_id"),
        *rows.columns,
        at.alias("check_timestamp"),
        F.year(at).alias("year"),
        F.month(at).alias("month"),
        F.dayofmonth(at).alias("day"),
    )


def _row_measures(checks: Sequence[Check]) -> dict[str, Column]:
    measures = {"_rows": F.count(F.lit(1))}
    for check in checks:
        if isinstance(check, NullCheck):
            measures |= {f"_null_{c}": F.count_if(F.col(c).isNull()) for c in check.columns}
        elif isinstance(check, NonNegativeCheck):
            measures |= {f"_negative_{c}": F.count_if(F.col(c) < 0) for c in check.columns}
    return measures


def _entries(check: Check, position: int) -> list[Column]:
    if isinstance(check, NullCheck):
        return [
            _count_entry(
                f"null_check_{c}", "No nulls", F.col(f"_null_{c}"), "nulls", f" in column {c}", position
            )
            for c in check.columns
        ]
    if isinstance(check, NonNegativeCheck):
        return [
            _count_entry(
                f"non_negative_check_{c}",
                "Values >= 0",
                F.col(f"_negative_{c}"),
                "invalid values",
                f" in column {c} (< 0)",
                position,
            )
            for c in check.columns
        ]
    if isinstance(check, RowCountCheck):
        expected = check.expected if isinstance(check.expected, Column) else F.lit(check.expected)
        observed = _text(F.col("_rows"), " rows")
        return [
            _entry(
                "row_count_exact_check",
                "validation",
                _text("Exactly ", expected, " rows"),
                observed,
                F.col("_rows") != expected,
                _text("Row count ", observed, " does not match expected ", expected),
                position,
            )
        ]
    columns = list(check.columns)
    n = F.col("_repeated") if check.count == "groups" else F.col("_rows") - F.col("_keys")
    return [
        _count_entry(
            f"multi_column_uniqueness_{'_'.join(columns)}",
            f"Unique combination of {columns}",
            n,
            "duplicate rows",
            f" for columns {columns}",
            position,
        )
    ]


def _measure(df: DataFrame, checks: Sequence[Check], keys: Sequence[str]) -> DataFrame:
    """All counts as one row; with keys, grouped by them first.

    The grouping combines map-side, counts NULL keys like any other, and carries the row-wise
    counts along, so the table is read once.
    """
    measures = _row_measures(checks)
    if not keys:
        return df.agg(*[m.alias(name) for name, m in measures.items()])
    per_key = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        *[m.alias(name) for name, m in measures.items()]
    )
    totals = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in measures]
    return per_key.agg(
        *totals, F.count(F.lit(1)).alias("_keys"), F.count_if(F.col("_rows") > 1).alias("_repeated")
    )


def evaluate(df: DataFrame, checks: Sequence[Check], ctx: LogContext) -> DataFrame:
    """Log rows of all checks, in their order."""
    keysets = list(dict.fromkeys(tuple(c.columns) for c in checks if isinstance(c, UniquenessCheck)))
    # Everything that needs no key of its own rides on the first key's aggregation.
    first, others = (keysets[0] if keysets else ()), keysets[1:]
    runs: dict[tuple, list] = {first: [], **{k: [] for k in others}}
    for position, check in enumerate(checks):
        keys = tuple(check.columns) if isinstance(check, UniquenessCheck) else first
        runs[keys].append((position, check))
    logs = []
    for keys, placed in runs.items():
        measured = _measure(df, [c for _, c in placed], keys)
        logs.append(_log_rows(measured, [e for p, c in placed for e in _entries(c, p)], ctx))
    return reduce(DataFrame.unionByName, logs)


def expected_rows(df: DataFrame, symbols: DataFrame, time_col: str = "extract_time") -> DataFrame:
    """One row: distinct known symbols times distinct extraction times (NULL is one of them)."""
    n_symbols = symbols.filter(F.col("symbol").isNotNull()).agg(F.count_distinct("symbol"))
    times = df.select(time_col).distinct().agg(F.count(F.lit(1)).alias("_times"))
    return times.select((n_symbols.scalar() * F.col("_times")).alias("expected_rows"))


def duplicate_delivery_check(
    incoming: DataFrame, bronze: DataFrame, ctx: LogContext, scope: str = "month"
) -> DataFrame:
    """Pairs of incoming and stored rows of one symbol in the same hour.

    ``scope`` limits the stored rows to the month of ``ctx.as_of`` or to the ``days`` of the
    incoming rows. Both sides are counted per key before they meet, so pairs are multiplied as
    numbers and never listed.
    """
    if scope == "month":
        stored = bronze.filter((F.col("year") == ctx.as_of.year) & (F.col("month") == ctx.as_of.month))
    elif scope == "days":
        at = F.col("extract_time")
        days = incoming.select(F.year(at).alias("year"), F.month(at).alias("month"), F.dayofmonth(at).alias("day"))
        stored = touched_by(bronze, days, BY_DAY)
    else:
        raise ValueError(f"scope must be 'month' or 'days', not {scope!r}")

    def per_hour(rows: DataFrame, name: str) -> DataFrame:
        keyed = rows.groupBy("symbol", extract_hour().alias("extract_hour"))
        return keyed.agg(F.count(F.lit(1)).alias(name))

    pairs = per_hour(incoming, "_new").join(per_hour(stored, "_old"), ["symbol", "extract_hour"])
    counted = pairs.agg(F.coalesce(F.sum(F.col("_new") * F.col("_old")), F.lit(0)).alias("_pairs"))
    n = F.col("_pairs")
    entry = _entry(
        "duplicate_file_check",
        "quality",
        F.lit("No duplicate (symbol, extract_time-hour) in Bronze table"),
        _text(n, " duplicates"),
        n > 0,
        _text(n, " duplicate (symbol, extract_time-hour) records found in Bronze table"),
    )
    return _log_rows(counted, [entry], ctx)


def file_arrival_check(spark: SparkSession, ctx: LogContext, prefix_mode: str = "string") -> DataFrame:
    """Whether the newest file below ``<table_path>/<year>/<month>`` came in the current hour.

    ``prefix_mode="string"`` treats the folder as a name prefix, so January also sees October to
    December; ``"folder"`` takes exactly the month.
    """
    now = ctx.as_of
    folder = f"{ctx.table_path}/{now.year}/{now.month}"
    files = list_files(spark, folder, string_prefix=prefix_mode == "string")
    newest = files.agg(F.max("modificationTime").alias("_at"), F.max_by("path", "modificationTime").alias("_path"))
    at = F.col("_at")
    came = F.date_format(at, "yyyy-MM-dd HH:mm:ssxxx")
    in_hour = F.date_trunc("hour", at) == F.date_trunc("hour", F.lit(now).cast("timestamp"))
    observed = F.when(at.isNull(), "Missing").when(in_hour, "Found").otherwise(came)
    message = F.when(at.isNull(), F.lit(f"No files found in folder {folder}")).otherwise(
        _text("Latest file ", F.col("_path"), " arrived at ", came, f", not in current hour {now.hour}")
    )
    entry = _entry(
        "file_arrival_check",
        "ingestion",
        F.lit(f"File for {now:%Y-%m-%d} hour {now:%H}"),
        observed,
        at.isNull() | ~in_hour,
        message,
    )
    return _log_rows(newest, [entry], ctx)


def _failure_message(failures: Sequence[Row]) -> str:
    """Text of the error for the failed rows of one check."""
    name, message = failures[0]["check_name"], failures[0]["error_message"]
    for prefix, text in (("null_check_", "Null"), ("non_negative_check_", "Non-negative value")):
        if name.startswith(prefix):
            columns = ", ".join(r["check_name"].removeprefix(prefix) for r in failures)
            return f"{text} check failed for columns: {columns}"
    if name == "row_count_exact_check":
        return f"Exact row count check failed: {message}"
    if name.startswith("multi_column_uniqueness_"):
        columns = failures[0]["expected_value"].removeprefix("Unique combination of ")
        return f"Multi-column uniqueness check failed for columns: {columns}"
    return f"Critical DQ check failed: {message}"


def enforce(log: DataFrame, log_path: str, critical: bool = True, tag: str | None = None) -> bool:
    """Append log rows to the log table, then raise if a check failed.

    The rows of one micro-batch carry its ``tag``. A further attempt at the batch puts its rows in the
    place of those of the attempt before, so the log tells how the batch went in the end; without a
    tag every call adds its rows.

    A critical run stops at the first failed check: that one is logged and raised, later ones
    are not logged. Otherwise all are logged. Returns whether everything passed. The log is as
    long as the list of checks, so reading its failures back is small.
    """
    log = log.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        failures = log.filter("status = 'FAIL'").collect()
        stop = min((r["_check"] for r in failures), default=None)
        kept = log if stop is None or not critical else log.filter(F.col("_check") <= stop)
        rows = kept.select(*DQ_LOG.names).coalesce(1)
        if tag:
            replace_batch(rows, log_path, BY_DAY, tag)
        else:
            write_batch(rows, log_path, BY_DAY, f"run-{uuid.uuid4().hex}")
    finally:
        log.unpersist()
    if failures and critical:
        raise DataQualityError(_failure_message([r for r in failures if r["_check"] == stop]))
    return not failures


def price_gate(prices: DataFrame, symbols: DataFrame) -> list[Check]:
    """Checks a batch of prices must pass before it is stored, in their order."""
    return [
        NonNegativeCheck(["current_price"]),
        RowCountCheck(expected_rows(prices, symbols).scalar()),
        UniquenessCheck(list(PRICE_KEY)),
        NullCheck(list(PRICE_KEY)),
    ]
