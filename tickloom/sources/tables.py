"""Table reads, static, through SQL and as a stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickloom.sources.feeds import MAX_AGE, bounded


def read_table(spark: SparkSession, path: str, schema: StructType, missing_ok: bool = False) -> DataFrame:
    """A Parquet table by path, with its declared columns.

    A missing folder is an error; with ``missing_ok``, for targets that a first run creates, it is
    an empty table.
    """
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if not missing_ok or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def select_all(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {table}")


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
    max_age: str = MAX_AGE,
) -> DataFrame:
    """New files of a Parquet table as a stream; ``feeds.bounded`` tells what the options do.

    A table that is written by keyed upsert rewrites whole partitions, and the stream would see
    those files again: read its change feed instead.
    """
    reader = bounded(spark.readStream.schema(schema), max_files, max_bytes, max_age)
    return reader.parquet(path).select(*schema.names)


def stream_catalog_table(spark: SparkSession, table: str) -> DataFrame:
    """New rows of a table known to the catalog, as a stream."""
    return bounded(spark.readStream).table(table)
