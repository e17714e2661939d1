"""tickloom: market snapshots to daily bars and indicators, as plain Spark jobs."""

__version__ = "0.1.0"
