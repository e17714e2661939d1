"""Tables whose partitions are replaced by pointing the catalog at a new folder.

A rewritten partition goes to a folder of its own, ``<path>_versions/<tag>``, and the catalog is then
told where it lies. A reader sees the old folder or the new one, whole; nothing that a reader uses is
ever written to. ``<path>_commits/<tag>`` says that a version is in place, which also lets a catalog
that does not outlive its session be filled again.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tickloom.config import Target
from tickloom.sinks.files import COMMITS, file_system

VERSIONS = "_versions"


def version_folder(target: Target, tag: str) -> str:
    return f"{target.path}{VERSIONS}/{tag}"


def ensure_table(spark: SparkSession, target: Target) -> None:
    """Create the table if the catalog lacks it, with the partitions that commits beside it tell of."""
    if spark.catalog.tableExists(target.name):
        return
    database = target.name.rsplit(".", 1)[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{target.path.rsplit('/', 1)[0]}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {target.name} ({target.spec.stored_schema.toDDL()}) USING parquet "
        f"PARTITIONED BY ({', '.join(target.spec.folders)}) LOCATION '{target.path}'"
    )
    if target.spec.versioned:
        restore(spark, target)


def read_target(spark: SparkSession, target: Target) -> DataFrame:
    """The declared columns of a table by its name; a table that was never written is empty."""
    ensure_table(spark, target)
    return spark.table(target.name).select(*target.spec.schema.names)


def in_partitions(touched: Sequence[Row], columns: Sequence[str]) -> Column:
    """Predicate for exactly these partitions, in literals, so that the catalog leaves out all others."""
    *lead, last = columns
    groups: dict[tuple, list] = {}
    for row in touched:
        groups.setdefault(tuple(row[c] for c in lead), []).append(row[last])
    out = F.lit(False)
    for values, lasts in groups.items():
        one = F.col(last).isin(sorted(lasts))
        for c, v in zip(lead, values):
            one = (F.col(c) == v) & one
        out = out | one
    return out


def _named(row: Row | dict, columns: Sequence[str]) -> str:
    return ", ".join(f"{c}={row[c]}" for c in columns)


def _folder(row: Row | dict, columns: Sequence[str]) -> str:
    return "/".join(f"{c}={row[c]}" for c in columns)


def point(spark: SparkSession, target: Target, touched: Sequence[Row | dict], folder: str) -> None:
    """Let the catalog find these partitions below ``folder``; each switches at once, new ones in one step."""
    columns = target.spec.partition_by
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {target.name}").collect()}
    place = lambda row: f"'{folder}/{_folder(row, columns)}'"
    added = [row for row in touched if _folder(row, columns) not in known]
    if added:
        clauses = " ".join(f"PARTITION ({_named(row, columns)}) LOCATION {place(row)}" for row in added)
        spark.sql(f"ALTER TABLE {target.name} ADD IF NOT EXISTS {clauses}")
    for row in touched:
        if _folder(row, columns) in known:
            spark.sql(f"ALTER TABLE {target.name} PARTITION ({_named(row, columns)}) SET LOCATION {place(row)}")


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a version that was refused; no reader was ever pointed at it."""
    fs, to_path = file_system(spark, folder)
    fs.delete(to_path(folder), True)


def _versions(spark: SparkSession, target: Target) -> list[tuple[int, str, dict]]:
    """Committed partition folders in the order of their commits: (time, folder, partition)."""
    fs, to_path = file_system(spark, target.path)
    commits = sorted((s.getModificationTime(), s.getPath().getParent().getName()) for s in fs.globStatus(to_path(f"{target.path}{COMMITS}/*/_SUCCESS")) or [])
    out = []
    columns = target.spec.partition_by
    for at, tag in commits:
        folder = version_folder(target, tag)
        for status in fs.globStatus(to_path("/".join([folder, *[f"{c}=*" for c in columns]]))) or []:
            names = status.getPath().toUri().getPath().split("/")[-len(columns) :]
            out.append((at, folder, dict(n.split("=", 1) for n in names)))
    return out


def restore(spark: SparkSession, target: Target) -> None:
    """Point the catalog at the newest committed folder of every partition."""
    newest: dict[str, tuple[str, dict]] = {}
    for _, folder, row in _versions(spark, target):
        newest[_folder(row, target.spec.partition_by)] = (folder, row)
    by_folder: dict[str, list[dict]] = {}
    for folder, row in newest.values():
        by_folder.setdefault(folder, []).append(row)
    for folder, rows in by_folder.items():
        point(spark, target, rows, folder)


def vacuum(spark: SparkSession, target: Target, keep_hours: float = 168.0) -> int:
    """Delete partition folders that were replaced more than ``keep_hours`` ago; returns how many.

    Readers that planned before the replacement have had that long to finish.
    """
    columns, limit = target.spec.partition_by, (time.time() - keep_hours * 3600) * 1000
    history: dict[str, list[tuple[int, str]]] = {}
    for at, folder, row in _versions(spark, target):
        history.setdefault(_folder(row, columns), []).append((at, folder))
    fs, to_path = file_system(spark, target.path)
    gone = 0
    for part, versions in history.items():
        for (_, folder), (replaced, _) in zip(versions, versions[1:]):
            if replaced < limit and fs.delete(to_path(f"{folder}/{part}"), True):
                gone += 1
    return gone
