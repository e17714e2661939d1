"""Fetched snapshots to landed CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tickloom.config import Lakehouse
from tickloom.operators.cleaning import (
    SNAPSHOT_FIELDS,
    STAMP_COLUMNS,
    normalize_snapshot,
    order_columns,
    stamp_partitions,
)
from tickloom.sinks.files import land_snapshot


def land(fetched: DataFrame, lake: Lakehouse, flag: str, taken_at: Column, shift_days: int = 0) -> str:
    """Shape one fetched snapshot of the ``pric`` or ``fund`` feed and land it."""
    if flag not in ("pric", "fund"):
        raise ValueError("wrong flag")
    stamped = stamp_partitions(fetched, taken_at, shift_days)
    if flag == "pric":
        fields = {**SNAPSHOT_FIELDS, **{c: c for c in STAMP_COLUMNS}}
        return land_snapshot(normalize_snapshot(stamped, fields), lake.landing(lake.price_feed))
    return land_snapshot(order_columns(stamped), lake.landing(lake.fundamentals_feed))
