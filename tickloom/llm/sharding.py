"""Shards in random order by a two-pass external shuffle.

Pass one scatters rows uniformly into buckets that fit in memory, by a seeded hash. Pass two shuffles
each bucket (Fisher-Yates) and writes it. The buckets one after another are a random order of all
rows; shards are equal cuts of it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import col, materialise, packed, sums_before, with_results

LAW = "rows"
#: Equal rows are dealt one by one if together they would fill more than this share of a bucket.
SHARE = 0.125
SAME = ("id", "crc", "size")


def numbers_of_equal(rows: DataFrame, many: DataFrame) -> DataFrame:
    """Rows whose (id, crc, size) is in ``many``, each with its number ``nth`` among its equals.

    Rows are written once and numbered within the task that wrote them; sums over the tasks give
    where each task starts. Which of two equal rows comes first hangs on the input split, but the
    numbers that a group of equals gets don't.
    """
    same = [rows[c].eqNullSafe(many[c]) for c in SAME]
    rows = materialise(rows.join(many, same, "left_semi").withColumn("uid", F.monotonically_increasing_id()), "equal-rows")
    rows = rows.withColumn("part", F.shiftright("uid", 33))
    ahead = rows.groupBy(*SAME, "part").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*SAME).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ahead.withColumn("ahead", F.coalesce(F.sum("n").over(w), F.lit(0))).drop("n")
    local = rows.withColumn("at", F.row_number().over(Window.partitionBy(*SAME, "part").orderBy("uid")))
    both = [local[c].eqNullSafe(ahead[c]) for c in (*SAME, "part")]
    return local.join(ahead, both).select(*[local[c] for c in (*SAME, "row")], (F.col("ahead") + F.col("at")).alias("nth"))


def scatter(docs: DataFrame, names: list[str], id_col: str, text_col: str, seed: int, bucket_bytes: int) -> tuple[DataFrame, int]:
    """Pass one: rows (id, size, crc, row, mark, bucket), and the number of buckets.

    The hash sees seed, id and checksum, so another split of the input, or a task that runs again,
    sends every row where it went before. Equal rows that would fill a bucket by themselves are
    found by counts, combined before the shuffle, and hashed with a number of their own.
    """
    text = F.encode(F.coalesce(col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(
        col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        packed(docs, names).alias("row"),
    )
    groups = materialise(rows.groupBy(*SAME).agg(F.count("*").alias("n")), "shard-groups")
    total = groups.agg(F.sum(F.col("n") * F.col("size"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    marked = lambda df, *more: df.withColumn("mark", F.xxhash64(F.lit(seed), F.col("id"), F.col("crc"), *more))
    many = materialise(groups.where((F.col("n") > 1) & (F.col("n") * F.col("size") > SHARE * bucket_bytes)).select(*SAME), "shard-many")
    if buckets == 1 or many.isEmpty():
        dealt = marked(rows)
    else:
        few = rows.join(many, [rows[c].eqNullSafe(many[c]) for c in SAME], "left_anti")
        dealt = marked(few).unionByName(marked(numbers_of_equal(rows, many), F.col("nth")).drop("nth"))
    return dealt.withColumn("bucket", F.pmod("mark", F.lit(buckets))), buckets


def shuffle_buckets(rows: DataFrame, buckets: int, seed: int) -> DataFrame:
    """Pass two: each bucket in an order of its own, written to the shared folder with its positions."""
    schema = rows.select("bucket", F.lit(0).cast("long").alias("place"), "id", "size", "crc", "row").schema

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by([("mark", "ascending"), ("size", "ascending"), ("crc", "ascending")])
        bucket = table.column("bucket")[0].as_py()
        order = np.random.default_rng([seed, bucket]).permutation(len(table))  # a Fisher-Yates shuffle
        table = table.take(pa.array(order))
        table = table.append_column("place", pa.array(np.arange(len(table)), pa.int64()))
        return table.select(["bucket", "place", "id", "size", "crc", "row"])

    return materialise(rows.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(one, schema), "shuffled-buckets")


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    columns: list[str] | None = None,
    seed: int = 17,
    bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """Put all rows into shards in random order; row counts of shards are at most one apart.

    Returns ``columns`` (all by default), then size (UTF-8 bytes of the text plus 8), text_crc32, law
    (``rows``), shard, slot (gapless from 0 in each shard) and grown_shard (null, it belongs to
    another law).

    * A null text counts as empty: size 8, checksum 0. A null id is an ordinary value.
    * The seed fixes shard and slot of every id and text, however the input is split. Rows that
      repeat id and text have a slot each; which of them gets which hangs on the input split.
    * A text is one value, however long; a bucket holds it whole.
    * With fewer rows than shards some shards stay empty; an empty table gives an empty result.
      A result takes the place of an input column of its name.

    A bucket holds about ``bucket_bytes`` of text, so a task needs a few times that; a longer text is
    a bucket's size by itself. The driver sees totals only. Starts of buckets are a written table,
    which Spark broadcasts if its size allows and shuffles otherwise.
    """
    names = docs.columns if columns is None else columns
    rows, buckets = scatter(docs, names, id_col, text_col, seed, bucket_bytes)
    written = shuffle_buckets(rows, buckets, seed)
    counts = written.groupBy("bucket").agg(F.count("*").alias("n"))
    total = F.lit(counts.agg(F.sum("n")).first()[0] or 0).cast("long")
    starts = materialise(sums_before(counts, [], "bucket", "n", "first").select(F.col("bucket").alias("of_bucket"), "first"), "shard-starts")
    placed = written.join(starts, F.col("bucket") == F.col("of_bucket"))
    placed = placed.withColumn("total", total).withColumn("at", F.col("first") + F.col("place"))
    placed = placed.withColumn("shard", F.expr(f"(at * {shards}) div total").cast("int"))
    # Shard s starts at the first position whose shard is s: s * total / shards, rounded up.
    slot = F.col("at") - F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return with_results(
        placed,
        "row",
        names,
        {
            "size": F.col("size"),
            "text_crc32": F.col("crc"),
            "law": F.lit(LAW),
            "shard": F.col("shard"),
            "slot": slot.cast("long"),
            "grown_shard": F.lit(None).cast("int"),
        },
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write a folder per shard, in the order of slots inside each file.

    The rows lie in the order of shards already, so a task meets few shards and nothing is shuffled.
    """
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
