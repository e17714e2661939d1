"""Exponential smoothing as window expressions.

The recurrence ``y[t] = (1-k) * y[t-1] + k * x[t]`` starts anew at every row flagged as a start.
Inside one block of BLOCK rows it has a closed form, a running sum of ``x[j] * (1-k)^-j``, whose
exponent is bounded by the block length and so cannot overflow. Between blocks only the last
value of each finished block is carried: block ends are folded in order, one step per BLOCK
rows. All of it runs in windows over the partitioning by symbol, without a further shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

BLOCK = 128

_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@dataclass(frozen=True)
class Smoothing:
    """One smoothed column: what it smooths, the weight of a new value, and where it starts."""

    name: str
    value: str
    seed: str
    weight: float
    previous: str | None = None

    @property
    def keep(self) -> float:
        return 1 - self.weight

    @property
    def start(self) -> str:
        """Value of a start row: a step on from stored state if there is any, else the seed."""
        if self.previous is None:
            return self.seed
        return f"coalesce({self.previous} * {self.keep}D + {self.value} * {self.weight}D, {self.seed})"


def mark_segments(df: DataFrame, max_gap_days: int) -> DataFrame:
    """Number the rows of each symbol, ordered by ``_day``, since its last start.

    A start is the first row, a row more than ``max_gap_days`` after the one before it, or a row
    after one without a price.
    """
    by_day = "OVER (PARTITION BY symbol ORDER BY _day"
    starts = (
        f"lag(_day) {by_day}) IS NULL OR _day - lag(_day) {by_day}) > {max_gap_days} "
        f"OR lag(avg_price) {by_day}) IS NULL"
    )
    numbered = df.selectExpr("*", f"row_number() {by_day}) AS _row", f"{starts} AS _starts")
    placed = numbered.selectExpr("*", f"max(CASE WHEN _starts THEN _row END) {by_day} {_SO_FAR}) AS _segment")
    counted = placed.selectExpr("*", "_row - _segment AS _pos", f"(_row - _segment) % {BLOCK} AS _offset")
    return counted.selectExpr("*", "_row - _offset AS _block")


MARKS = ("_row", "_starts", "_segment", "_pos", "_offset", "_block")


def smooth(marked: DataFrame, smoothings: Sequence[Smoothing]) -> DataFrame:
    """Add the smoothed columns to rows prepared by ``mark_segments``.

    A row without a value gets none, unless it is a start. A weight of 1 keeps nothing of the
    past, so the column is the value itself.
    """
    local, ends, out = {}, {}, {}
    for s in smoothings:
        if s.keep == 0:
            out[s.name] = f"CASE WHEN _pos = 0 THEN {s.start} ELSE {s.value} END"
            continue
        in_block, block_ends = f"_local_{s.name}", f"_ends_{s.name}"
        term = f"CASE WHEN _pos = 0 THEN {s.start} ELSE {s.value} * {s.weight}D END"
        decay = f"pow({s.keep}D, _offset)"
        local[in_block] = (
            f"sum(({term}) / {decay}) OVER (PARTITION BY symbol, _segment, _block ORDER BY _day {_SO_FAR}) * {decay}"
        )
        ends[block_ends] = (
            f"collect_list(CASE WHEN _offset = {BLOCK - 1} THEN {in_block} END) "
            f"OVER (PARTITION BY symbol, _segment ORDER BY _block, _day {_BEFORE})"
        )
        # State before this block: the ends of the blocks before it, folded oldest first.
        state = f"aggregate({block_ends}, 0D, (state, last) -> state * {s.keep**BLOCK}D + last)"
        out[s.name] = (
            f"CASE WHEN _pos = 0 OR {s.value} IS NOT NULL "
            f"THEN {in_block} + {state} * {decay} * {s.keep}D END"
        )
    for stage in (local, ends, out):
        marked = marked.selectExpr("*", *[f"{expression} AS {name}" for name, expression in stage.items()])
    return marked.drop(*local, *ends)
