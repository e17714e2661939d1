"""Indicator table kept up to date from changed bars."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import since_month
from tickloom.operators.cleaning import add_prev_prefix
from tickloom.operators.history import newest_per_symbol
from tickloom.operators.indicators import LOOKBACK_DAYS, MAX_GAP_DAYS, WINDOWS, indicators_from


def refreshed_indicators(
    changed: DataFrame,
    bars: DataFrame,
    gold: DataFrame,
    windows: Sequence[int] = WINDOWS,
    order: str = "newest_first",
    refresh: str = "following",
) -> DataFrame | None:
    """Indicator rows to store after some bars changed; None if nothing did.

    Each changed symbol is recomputed from its first changed date on. It reads the bars of the
    90 days before that date and the newest stored row of the 5 days before it. With
    ``refresh="following"`` all later rows of the symbol are returned, since they depend on the
    changed bars; the stored table then equals a full computation, whatever the order of
    arrival. With ``refresh="batch"`` only the changed rows are returned.
    """
    if refresh not in ("following", "batch"):
        raise ValueError(f"refresh must be 'following' or 'batch', not {refresh!r}")
    earliest = changed.agg(F.min("date").alias("day")).first()["day"]
    if earliest is None:
        return None
    first = changed.groupBy("symbol").agg(F.min("date").alias("_from"))

    reach = earliest - timedelta(days=LOOKBACK_DAYS)
    days = F.col("date")
    context = (
        bars.filter(since_month(reach) & (days >= F.lit(reach)))
        .join(first, "symbol")
        .filter(days >= F.date_sub("_from", LOOKBACK_DAYS))
    )
    reach = earliest - timedelta(days=MAX_GAP_DAYS)
    stored = (
        gold.filter(since_month(reach) & (days >= F.lit(reach)))
        .join(first, "symbol")
        .filter((days >= F.date_sub("_from", MAX_GAP_DAYS)) & (days < F.col("_from")))
        .drop("_from")
    )
    state = add_prev_prefix(newest_per_symbol(stored))
    fresh = indicators_from(context, state, windows, order)
    if refresh == "batch":
        fresh = fresh.join(changed.select("symbol", "date"), ["symbol", "date"], "left_semi")
    return fresh
