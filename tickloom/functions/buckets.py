"""Size, margin and growth categories of a company."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds and labels, highest first; the last label takes the rest.
MARKET_CAP = ((200e9, "Mega Cap"), (10e9, "Large Cap"), (2e9, "Mid Cap")), "Small Cap"
EMPLOYEES = ((10_000, "Large Workforce"), (1_000, "Medium Workforce")), "Small Workforce"
MARGIN = ((0.2, "High Margin"), (0.05, "Moderate Margin")), "Low Margin"
GROWTH = ((0.15, "High Growth"), (0.05, "Moderate Growth")), "Low or Negative Growth"


def bucket(column: str, bounds: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first lower bound the value reaches; NULL falls to ``rest``."""
    steps = reduce(
        lambda chain, step: chain.when(F.col(column) >= step[0], step[1]), bounds, F
    )
    return steps.otherwise(rest)


def market_cap_category(column: str = "marketCap") -> Column:
    return bucket(column, *MARKET_CAP)


def employee_category(column: str = "fullTimeEmployees") -> Column:
    return bucket(column, *EMPLOYEES)


def margin_category(column: str = "profitMargins") -> Column:
    return bucket(column, *MARGIN)


def growth_category(column: str = "revenueGrowth") -> Column:
    return bucket(column, *GROWTH)
