"""Databases and tables of a lakehouse, from the schema registry."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tickloom.config import Lakehouse
from tickloom.schemas import TABLES
from tickloom.sinks.catalog import ensure_table


def create_databases(spark: SparkSession, lake: Lakehouse) -> None:
    for layer in dict.fromkeys(t.layer for t in TABLES.values()):
        location = f"{lake.root}/{lake.env}/{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.database(layer)} LOCATION '{location}'")


def create_tables(spark: SparkSession, lake: Lakehouse) -> None:
    """Create what is missing; existing tables and their data stay."""
    for key in TABLES:
        ensure_table(spark, lake.target(key))


def set_up(spark: SparkSession, lake: Lakehouse) -> None:
    create_databases(spark, lake)
    create_tables(spark, lake)


def refresh_partitions(spark: SparkSession, lake: Lakehouse, key: str) -> None:
    """Make partitions that were appended by path visible to the catalog; upserted tables need none of it."""
    spark.catalog.recoverPartitions(lake.table(key))
    spark.catalog.refreshTable(lake.table(key))
