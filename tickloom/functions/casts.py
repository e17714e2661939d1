"""Casts that give NULL instead of stopping the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(column: str) -> Column:
    """BIGINT value of a number or numeric text, fraction cut off.

    The direct cast keeps all digits of integer text. Text such as ``1.5E11`` or ``12.7`` goes
    through DOUBLE. What fits neither (no number, overflow, NaN) becomes NULL.
    """
    c = F.col(column)
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
