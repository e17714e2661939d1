"""Read only those partitions of a table that a set of changes touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def span_of(columns: Sequence[str]) -> list[Column]:
    """Aggregates of the first and last partition: one row, however many partitions there are."""
    part = F.struct(*columns)
    known = F.when(~F.exists(F.array(*[F.col(c).isNull() for c in columns]), lambda x: x), part)
    return [F.min(known).alias("_first"), F.max(known).alias("_last")]


def within(span: Row, columns: Sequence[str]) -> Column:
    """Predicate on partition columns from the first to the last partition; literal, so the scan skips the rest."""
    first, last = span["_first"], span["_last"]
    lit = lambda row: F.struct(*[F.lit(row[c]).alias(c) for c in columns])
    lead = F.col(columns[0]).between(first[columns[0]], last[columns[0]])
    return lead & F.struct(*columns).between(lit(first), lit(last))


def touched_by(table: DataFrame, changes: DataFrame, columns: Sequence[str], span: Row | None = None) -> DataFrame:
    """Rows of ``table`` in the partitions that occur in ``changes``.

    The range from the first to the last partition prunes the scan, for any number of partitions;
    a semi-join takes the exact ones. The driver sees the two ends only.
    """
    columns = list(columns)
    span = span or changes.agg(*span_of(columns)).first()
    if span["_first"] is None:
        return table.limit(0)
    touched = changes.select(*columns).dropna().distinct()
    return table.filter(within(span, columns)).join(touched, columns, "left_semi").select(*table.columns)
