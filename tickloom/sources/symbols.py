"""The list of tracked symbols: one per line, no header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed, non-blank lines; repeated lines stay."""
    lines = spark.read.text(path)
    return lines.select(F.trim("value").alias("symbol")).filter("symbol <> ''")


def read_symbol_column(spark: SparkSession, path: str) -> DataFrame:
    """First CSV field of each line, untrimmed; blank lines are skipped by the reader."""
    return spark.read.csv(path, header=False, schema="symbol string")
