"""Keyed upsert into a partitioned Parquet table of the catalog, and MERGE where the table format has one."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from tickloom.config import Target, shared_folder
from tickloom.schemas import TableSpec
from tickloom.sinks.catalog import discard, ensure_table, in_partitions, point, version_folder
from tickloom.sinks.files import COMMITS, exists, mark, write_batch

_HIT = "_hit"

#: How a stored column follows from the columns of the old row and those of the change.
Combine = Mapping[str, Callable[[Callable[[str], Column], Callable[[str], Column]], Column]]


class DuplicateKeyError(ValueError):
    """The changes hold a key more than once, so the stored row would be a matter of chance."""


class MovedPartitionError(ValueError):
    """A partition column does not follow from the date, so an old row could stay behind or be lost."""


def merge_rows(
    old: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Old rows with the changes applied.

    Matched rows take the ``update`` columns from the changes, or all columns if it is None;
    unmatched changes are added. Keys are unique on both sides, so no join multiplies rows, and
    a small set of changes is broadcast by the planner instead of shuffling the old rows.
    """
    keys, columns = list(keys), old.columns
    if update is None:
        return old.join(changes.select(*keys), keys, "left_anti").unionByName(changes.select(*columns))
    new = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias(_HIT))
    matched = old.join(new, keys, "left").select(
        *[
            F.when(F.col(_HIT), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
            for c in columns
        ]
    )
    added = changes.join(old.select(*keys), keys, "left_anti").select(*columns)
    return matched.unionByName(added)


def merged(
    old: DataFrame, changes: DataFrame, spec: TableSpec, update: Sequence[str] | None = None, combine: Combine | None = None, splits: int = 1
) -> DataFrame:
    """Old rows with the changes applied, in one pass and one shuffle.

    Both are one tagged union, and an aggregate per key puts out the row to store, how many changes it
    has (``_copies``) and whether a declared column changed (``_changed``). Matched rows take the ``update``
    columns from the changes, or all if it is None; ``combine`` says how a column follows from both
    rows instead. The shuffle deals by partition, so that each is written by one task, or by ``splits``.
    """
    parts, names = list(spec.partition_by), spec.stored_schema.names
    keys = [k for k in spec.key if k not in parts]
    values = [c for c in names if c not in keys and c not in parts]
    salt = F.pmod(F.xxhash64(*keys), F.lit(splits)).alias("_salt")
    lacking = [c for c in names if c not in changes.columns]
    changes = changes.withColumns({c: F.lit(None).cast(spec.stored_schema[c].dataType) for c in lacking})
    rows = old.select(*names, F.lit(False).alias("_new")).unionByName(changes.select(*names, F.lit(True).alias("_new")))
    dealt = rows.select("*", salt).repartition(*parts, "_salt")
    # As text: a table of many columns would take long to put together column by column.
    sides = [F.expr(f"max(if({'' if new else 'not '}_new, `{c}`, null)) `_{'new' if new else 'old'}_{c}`") for c in values for new in (False, True)]
    counts = [F.expr("count_if(not _new) _before"), F.expr("cast(count_if(_new) as int) _copies")]
    pairs = dealt.groupBy(*keys, *parts, "_salt").agg(*counts, *sides)
    both = F.expr("_before > 0 and _copies > 0")

    def value(c: str) -> Column:
        if update is not None and c not in update and c not in spec.partials.names:
            return F.expr(f"if(_before > 0, `_old_{c}`, `_new_{c}`)")
        plain = F.expr(f"if(_copies > 0, `_new_{c}`, `_old_{c}`)")
        if not combine or c not in combine:
            return plain
        return F.when(both, combine[c](lambda x: F.col(f"_old_{x}"), lambda x: F.col(f"_new_{x}"))).otherwise(plain)

    stored = pairs.select("*", *[value(c).alias(c) for c in values])
    changed = " or ".join(["_before = 0", *[f"not (`{c}` <=> `_old_{c}`)" for c in values if c in spec.schema.names]])
    return stored.select(*names, "_copies", F.expr(f"_copies > 0 and ({changed}) _changed"))


def touched_partitions(changes: DataFrame, spec: TableSpec) -> list[Row]:
    """The partitions that changes touch, a row each; refuses rows whose partition doesn't follow from the date."""
    parts = list(spec.partition_by)
    derived = {"year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date")}
    agree = reduce(and_, [F.col(c) == derived[c] for c in parts])
    found = changes.groupBy(*parts).agg(F.max((~F.coalesce(agree, F.lit(False))).cast("int")).alias("_moved")).collect()
    if any(r["_moved"] for r in found):
        raise MovedPartitionError(f"{spec.name}: partition columns must follow from the date")
    return found


def feed_path(path: str) -> str:
    """Where the change feed of the table at ``path`` is kept."""
    return f"{path}_changes"


def upsert(
    changes: DataFrame,
    target: Target,
    update: Sequence[str] | None = None,
    tag: str | None = None,
    combine: Combine | None = None,
    splits: int = 1,
) -> None:
    """Apply changes to a table of the catalog; only touched partitions are read, and rewritten elsewhere.

    There must be a single writer. Steps, each of which may be the last before a crash: the changes are
    written to the shared folder, so that they are computed once; the merged partitions are written to
    a version folder of their own; the catalog is pointed there, partition by partition; the change feed
    gets the keys that really changed; a marker says that ``tag`` is done. Readers see old or new rows of
    a partition at every moment. A repeated call with the same tag takes up where the first one stopped:
    a version that is whole is not computed again, so that combined sums count once.
    """
    spark, spec = changes.sparkSession, target.spec
    ensure_table(spark, target)
    tag = tag or f"run-{uuid.uuid4().hex}"
    marker, version = f"{target.path}{COMMITS}/{tag}", version_folder(target, tag)
    if exists(spark, marker):
        return
    parts = list(spec.partition_by)
    written = StructType([*spec.stored_schema.fields, StructField("_copies", IntegerType()), StructField("_changed", BooleanType())])
    if not exists(spark, f"{version}/_SUCCESS"):
        staged = shared_folder(spark, f"upsert-{spec.name}")
        changes.select(*[c for c in spec.stored_schema.names if c in changes.columns]).write.parquet(staged)
        changes = spark.read.schema(StructType([f for f in spec.stored_schema if f.name in changes.columns])).parquet(staged)
        touched = touched_partitions(changes, spec)
        if not touched:
            return
        old = spark.table(target.name).filter(in_partitions(touched, parts))
        merged(old, changes, spec, update, combine, splits).write.mode("overwrite").partitionBy(*parts).parquet(version)
    fresh = spark.read.schema(written).parquet(version)
    about = fresh.groupBy(*parts).agg(F.max("_copies").alias("_copies")).collect()
    if any(r["_copies"] > 1 for r in about):
        discard(spark, version)
        raise DuplicateKeyError(f"{spec.name}: a key of {spec.key} occurs more than once")
    point(spark, target, about, version)
    if spec.change_feed:
        write_batch(fresh.where("_changed").select(*spec.feed_schema.names), feed_path(target.path), spec.partition_by, tag)
    mark(spark, marker)


def merge_into(
    changes: DataFrame, table: str, keys: Sequence[str], update: Sequence[str] | None = None
) -> None:
    """The same upsert as a MERGE statement, for a catalog table whose format supports it.

    No such format is installed here: only the refusal by Parquet is tested.
    """
    source, target = changes.alias("source"), table.rsplit(".", 1)[-1]
    match = reduce(and_, [F.col(f"{target}.{k}") == F.col(f"source.{k}") for k in keys])
    merge = source.mergeInto(table, match)
    if update is None:
        merge = merge.whenMatched().updateAll()
    else:
        merge = merge.whenMatched().update({c: F.col(f"source.{c}") for c in update})
    merge.whenNotMatched().insertAll().merge()
