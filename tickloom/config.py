"""Where a deployment keeps its tables, landing folders and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tickloom.schemas import TABLES, TableSpec


@dataclass(frozen=True)
class Target:
    """A table by its name in the catalog, with its folder and schema."""

    name: str
    path: str
    spec: TableSpec


@dataclass(frozen=True)
class Lakehouse:
    """Names and paths derived from one environment name and one root folder."""

    root: str
    env: str = "dev"
    price_feed: str = "hourly_prices"
    fundamentals_feed: str = "daily_fundamentals"

    def database(self, layer: str) -> str:
        return f"{self.env}_{layer}"

    def table(self, key: str) -> str:
        spec = TABLES[key]
        return f"{self.database(spec.layer)}.{spec.name}"

    def path(self, key: str) -> str:
        spec = TABLES[key]
        return f"{self.root}/{self.env}/{spec.layer}/{spec.name}"

    def target(self, key: str) -> Target:
        return Target(self.table(key), self.path(key), TABLES[key])

    def landing(self, feed: str) -> str:
        return f"{self.root}/{self.env}/raw-data/{feed}"

    def checkpoint(self, stream: str) -> str:
        return f"{self.root}/{self.env}/checkpoints/{stream}"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    It sits below ``spark.checkpoint.dir``. Only a local session without that setting gets a
    temporary folder of this machine; a cluster without it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tickloom-")
    return f"{base.rstrip('/')}/tickloom/{purpose}-{uuid.uuid4().hex}"
