"""Exact de-duplication with a cuckoo-filter index of live digests.

The digest of a text is SHA-256 over the text with every run of white space replaced by one space.
Digests are spread over parts by their leading bits. Each part is one cuckoo filter over its live
digests and, beside every slot, the stored key: digest and length. A filter hit alone decides
nothing, it is verified against the stored keys of the two buckets it points to. When an insertion
finds no place, the filter is built again at twice the size from the stored keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SPACES, col, materialise, packed, placed, unpacked, with_results

SLOTS = 4
MAX_KICKS = 200
MASK = (1 << 64) - 1


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four slots, each slot with its stored key beside it.

    Keys are digests as bytes; equal keys are stored once. The other bucket of a fingerprint is
    found from the bucket and the fingerprint alone, so entries move without their keys.
    """

    def __init__(self, expected: int = 1) -> None:
        self.resizes = 0
        self._clear(expected)

    def _clear(self, expected: int) -> None:
        self.buckets = 1 << max(1, math.ceil(math.log2(max(1, expected) / (SLOTS * 0.9))))
        self.prints = [0] * (self.buckets * SLOTS)
        self.keys: list[bytes | None] = [None] * (self.buckets * SLOTS)
        self.values: list = [None] * (self.buckets * SLOTS)
        self.live = 0

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[8:10], "big") or 1
        first = int.from_bytes(key[10:18], "big") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E9955BD1E995 & MASK) >> 17) & (self.buckets - 1)

    def slot(self, key: bytes) -> int | None:
        """The slot of a live key: a fingerprint hit, verified against the stored key."""
        mark, first, second = self._places(key)
        for bucket in (first, second):
            for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[at] == mark and self.keys[at] == key:
                    return at
        return None

    def insert(self, key: bytes, value: object = None) -> None:
        """Store a key that isn't live yet; overflow doubles the filter from its stored keys."""
        mark, first, second = self._places(key)
        for bucket in (first, second):
            for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[at]:
                    self.prints[at], self.keys[at], self.values[at] = mark, key, value
                    self.live += 1
                    return
        bucket = second
        for kick in range(MAX_KICKS):
            at = bucket * SLOTS + (kick * 7 + mark) % SLOTS
            mark, self.prints[at] = self.prints[at], mark
            key, self.keys[at] = self.keys[at], key
            value, self.values[at] = self.values[at], value
            bucket = self._other(bucket, mark)
            for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[at]:
                    self.prints[at], self.keys[at], self.values[at] = mark, key, value
                    self.live += 1
                    return
        stored = [(k, v) for k, v in zip(self.keys, self.values) if k is not None] + [(key, value)]
        self.resizes += 1
        self._clear(2 * SLOTS * self.buckets)
        for k, v in stored:
            self.insert(k, v)

    def delete(self, key: bytes) -> bool:
        """Remove a live key; False if it isn't live."""
        at = self.slot(key)
        if at is None:
            return False
        self.prints[at], self.keys[at], self.values[at] = 0, None, None
        self.live -= 1
        return True


def normal_text(text: Column) -> Column:
    """Null as empty, runs of white space as one space."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as bytes."""
    return F.unhex(F.sha2(F.encode(normal_text(text), "UTF-8"), 256))


def _part(parts: int) -> Column:
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long"), F.lit(parts)).cast("int")


LIVE = "part int, digest binary, missing boolean, keep_id {id}, keep_uid long, rows long"


def build_index(entries: DataFrame, parts: int) -> DataFrame:
    """Insert entries (digest, missing, id, uid, rows) into the filters of all parts: the live digests.

    Entries of one digest may come from many tasks. A miss inserts the digest; a verified hit adds
    the rows and keeps the smaller (missing, id, uid).
    """
    id_type = entries.schema["id"].dataType.simpleString()
    schema = LIVE.format(id=id_type)
    id_arrow = entries.select("id").limit(0).toArrow().schema.field("id").type

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, index = None, CuckooFilter(1)
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                p, key, entry, n = row[0], row[1], row[2:5], row[5]
                if p != part:
                    if part is not None:
                        yield from live_rows(part, index, id_arrow)
                    part, index = p, CuckooFilter(1)
                at = index.slot(key)
                if at is None:
                    index.insert(key, (entry, n))
                else:
                    known, m = index.values[at]
                    index.values[at] = (min(known, entry, key=_order), n + m)
        if part is not None:
            yield from live_rows(part, index, id_arrow)

    rows = entries.select(_part(parts).alias("part"), "digest", "missing", "id", "uid", "rows")
    return rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(fill, schema)


def _order(entry: tuple) -> tuple:
    missing, key, uid = entry
    return (missing, 0 if missing else key, uid)


def live_rows(part: int, index: CuckooFilter, id_type: pa.DataType, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    """The stored keys of one part as rows."""
    found = [(k, v) for k, v in zip(index.keys, index.values) if k is not None]
    for i in range(0, len(found), size):
        some = found[i : i + size]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(some), pa.int32()),
                pa.array([k for k, _ in some], pa.binary()),
                pa.array([v[0][0] for _, v in some], pa.bool_()),
                pa.array([v[0][1] for _, v in some], id_type),
                pa.array([v[0][2] for _, v in some], pa.int64()),
                pa.array([v[1] for _, v in some], pa.int64()),
            ],
            ["part", "digest", "missing", "keep_id", "keep_uid", "rows"],
        )


def delete_from_index(live: DataFrame, gone: DataFrame, parts: int) -> DataFrame:
    """Take the digests of ``gone`` out of the filters of ``live``; digests that aren't live change nothing."""
    id_arrow = live.select("keep_id").limit(0).toArrow().schema.field("keep_id").type
    none = live.schema["keep_id"].dataType.simpleString()
    both = live.select("part", "digest", "missing", "keep_id", "keep_uid", "rows").unionByName(
        gone.select(_part(parts).alias("part"), "digest").distinct().selectExpr("part", "digest", "false missing", f"cast(null as {none}) keep_id", "-1L keep_uid", "-1L rows")
    )

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, index = None, CuckooFilter(1)
        for batch in batches:
            for p, key, *entry, n in zip(*[c.to_pylist() for c in batch.columns]):
                if p != part:
                    if part is not None:
                        yield from live_rows(part, index, id_arrow)
                    part, index = p, CuckooFilter(1)
                if n < 0:
                    index.delete(key)
                else:
                    index.insert(key, (tuple(entry), n))
        if part is not None:
            yield from live_rows(part, index, id_arrow)

    ordered = both.repartition(parts, "part").sortWithinPartitions("part", F.col("rows") < 0)
    return ordered.mapInArrow(change, live.schema)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    columns: list[str] | None = None,
    rows_per_part: int = 200_000,
) -> DataFrame:
    """Find rows of equal text; of each group the row with the smallest id stays.

    Returns a row per input row: the ``columns`` (all by default), then keep_id, group_size, kept and
    text_sha256 (lower-case hex). Texts are equal when identical after replacing each run of white
    space by one space.

    * A null text is an empty text; empty and blank texts are ordinary texts.
    * A null id sorts after all others: its row stays only if no row of the group has an id.
    * Of rows that repeat the smallest id as well, exactly one stays.
    * An empty table gives an empty result. A result takes the place of an input column of its name.

    Copies are combined in each input partition before they are shuffled, so a text that a third of
    all rows share is one entry from each; a part holds about ``rows_per_part`` entries at most.
    """
    names = docs.columns if columns is None else columns
    rows = materialise(
        docs.select(digest(col(text_col)).alias("digest"), col(id_col).alias("id"), packed(docs, names).alias("row"))
        .select("*", F.monotonically_increasing_id().alias("uid")),
        "exact-rows",
    )
    entry = F.struct(F.col("id").isNull().alias("missing"), "id", "uid")
    entries = (
        rows.groupBy("digest", F.spark_partition_id().alias("task"))
        .agg(F.min(entry).alias("e"), F.count("*").alias("rows"))
        .select("digest", "e.*", "rows")
    )
    parts = max(1, math.ceil(rows.count() / rows_per_part))
    live = build_index(entries, parts).select("digest", "keep_id", "keep_uid", F.col("rows").alias("group_size"))
    found = rows.join(live, "digest")
    return with_results(
        found,
        "row",
        names,
        {
            "keep_id": F.col("keep_id"),
            "group_size": F.col("group_size"),
            "kept": F.col("uid") == F.col("keep_uid"),
            "text_sha256": F.lower(F.hex("digest")),
        },
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that :func:`exact_dedup` keeps, with exactly the columns of ``docs``.

    Digests and ids alone are written and grouped; texts are shuffled once to meet what is kept.
    """
    rows = placed(docs, "exact-documents")
    light = rows.select("uid", F.col("row").getField(id_col).alias("_id"), F.col("row").getField(text_col).alias("_text"))
    kept = exact_dedup(light, "_id", "_text", ["uid"]).where("kept").select("uid")
    return rows.join(kept, "uid", "left_semi").select(*unpacked(rows, "row", docs.columns))
