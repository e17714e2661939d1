"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source is a queue: its documents in shuffled order, repeated up to ``max_epochs`` times. A
copy of a document finishes at the virtual time (tokens of its queue up to and with it) / target of
the source. The copies of all sources in the order of virtual finish time, cut off at the total
budget, are the mix: at virtual time 1 every source has sent exactly its target.

Running sums are made in levels: sums of ranges, combined before they are shuffled, a running sum
over the ranges by spans of them, then a window inside each range. Ranges are cut by rank of a hash or by
virtual time, and their number grows with the rows, so no window holds a whole source.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, col, materialise, packed, placed, sums_before, unpacked, with_results

ROWS_PER_RANGE = 10_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources in order of code points, null last, get the weights in turn. All sizes together are
    shared by weight; a target stops at ``max_epochs`` times its source's size and the excess is
    shared again by weight among the others, until none is above. That fixed point is
    least(limit, weight * level); the level is found in the order of limit / weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", given).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("open", F.sum("weight").over(after))
    s = s.withColumn("total", F.sum("source_size").over(Window.partitionBy()).cast("double"))
    s = s.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(Window.partitionBy())
    return s.select("source", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


def _running(df: DataFrame, group: list[str], ranges: str, value: str, order: list, out: str) -> DataFrame:
    """Running sum of ``value`` within ``group`` in the order of (ranges, order), in two levels."""
    sums = df.groupBy(*group, ranges).agg(F.sum(value).alias("range_sum"))
    keys = [*group, ranges]
    sums = sums_before(sums, group, ranges, "range_sum", "ahead")
    ahead = sums.select(*[F.col(c).alias(f"of_{c}") for c in keys], "ahead")
    joined = df.join(ahead, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in keys]).drop(*[f"of_{c}" for c in keys])
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn(out, F.col("ahead") + F.sum(value).over(inner)).drop("ahead")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    columns: list[str] | None = None,
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    seed: str = "mix",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Decide how often each document is taken; a row per input row.

    Returns ``columns`` (all by default), then size (words of the text), source_size, target and
    taken (words taken, repeats counted: size times the number of copies in the mix).

    * A null or blank text has size 0; it is taken with 0 words.
    * A null source is a source of its own, the last one.
    * The shuffle orders by MD5 of seed and id, so reruns and other partitionings agree. Rows that
      repeat an id follow each other by size; equal ones can't be told apart.
    * A source without words has target 0. An empty table gives an empty result. A result takes the
      place of an input column of its name.
    """
    names = docs.columns if columns is None else columns
    size = F.coalesce(F.regexp_count(col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = materialise(
        docs.select(col(source_col).cast("string").alias("source"), size.alias("size"), key.alias("key"), packed(docs, names).alias("row")),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = materialise(source_targets(sizes.drop("n"), weights, max_epochs), "mix-targets")
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("budget")).first()
    ranges = max(1, math.ceil(totals["n"] / rows_per_range))
    named = targets.withColumnRenamed("source", "of_source")
    with_target = rows.join(named, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    part = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(ranges) / F.lit(1 << 32)).cast("int")
    queued = _running(with_target.withColumn("range", part), ["source"], "range", "size", ["key", "size"], "sent")
    # Virtual finish time of copy e: (e * source_size + sent) / target.
    finish = lambda e: F.when(F.col("target") > 0, (F.lit(e) * F.col("source_size") + F.col("sent")).cast("double") / F.col("target"))
    queued = materialise(queued.drop("range"), "mix-queues")
    copies = queued.where("size > 0 and target > 0").select(
        "size", "key", F.posexplode(F.array(*[finish(e) for e in range(max_epochs)])).alias("epoch", "finish")
    )
    # Up to time 1 all sources send, so equal steps of time hold equal words; later ever fewer do.
    v = F.col("finish")
    binned = copies.withColumn("bin", F.floor(F.when(v <= 1, v * ranges).otherwise(ranges + F.log(v) * (max_epochs * ranges))).cast("int"))
    sent = _running(binned, [], "bin", "size", ["finish", "key", "size"], "mixed")
    cut = sent.where(F.col("mixed") <= F.lit(totals["budget"])).agg(F.max(F.struct("finish", "key", "size")).alias("cut")).first()["cut"]
    if cut is None:
        taken = F.lit(0).cast("long")
    else:
        limit = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["key"]).alias("key"), F.lit(cut["size"]).cast("long").alias("size"))
        within = [(F.struct(finish(e).alias("finish"), F.col("key"), F.col("size")) <= limit) & finish(e).isNotNull() for e in range(max_epochs)]
        taken = F.col("size") * sum((x.cast("long") for x in within[1:]), within[0].cast("long"))
    return with_results(
        queued,
        "row",
        names,
        {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"), "taken": F.when(F.col("size") > 0, taken).otherwise(F.lit(0).cast("long"))},
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how: object) -> DataFrame:
    """The mix itself: each document as often as it is taken, with exactly the columns of ``docs``.

    The running sums see row numbers only. Decisions are a written table of two numbers a row, which
    Spark broadcasts while its size on disk allows; beyond that texts are shuffled once to meet them.
    Null texts and texts without words are never taken, a long text is taken whole, rows that repeat
    are rows like all others, and an empty table gives an empty one.
    """
    rows = placed(docs, "mix-documents")
    light = rows.select("uid", *[F.col("row").getField(c).alias(own) for own, c in (("_id", id_col), ("_text", text_col), ("_source", source_col))])
    taken = mix(light, "_id", "_text", "_source", ["uid"], **how).where("taken > 0")
    times = materialise(taken.select("uid", F.expr("cast(taken div size as int)").alias("times")), "mix-times")
    return rows.join(times, "uid").withColumn("time", F.explode(F.expr("sequence(1, times)"))).select(*unpacked(docs, "row", docs.columns))
