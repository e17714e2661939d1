"""What the searches over vectors share: comparable rows, samples by length, blocks of residents and visitors, the first of each query."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import materialise

SAMPLE = 20_000
RESIDENTS, VISITORS = 4096, 2048
GROUPS_A_TASK, MOST_TASKS = 4, 20_000
#: Columns that make one group: a part of a cell's residents and a part of its visitors.
GROUP = ["length", "cell", "part", "call"]


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def name_of(vector: Column) -> Column:
    """Equal vectors have one name: a digest of their numbers as text."""
    return F.md5(F.array_join(vector.cast("array<string>"), ","))


def in_order(score: bool = False) -> list[Column]:
    """Largest score first, then the smallest id, null ids last; rows that repeat an id by their number."""
    return [*([F.col("score").desc()] if score else []), F.col("id").isNull(), F.col("id"), F.col("uid")]


def firsts(rows: DataFrame, by: list[str], k: int, score: bool = False) -> DataFrame:
    """The first ``k`` rows of each group; tasks drop what can't be among them before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*in_order(score)))
    return rows.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows, in double precision."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), len(flat) // max(1, len(vectors)))


def samples(rows: DataFrame, most: int = SAMPLE) -> Iterator[dict[int, tuple[int, np.ndarray]]]:
    """Of rows (key, length, vector): by length, how many there are and at most ``most`` different ones.

    Lengths come in turns whose samples are at most ``most`` rows in all, so the driver holds no more
    however many lengths there are; small lengths share a turn and are taken whole.
    """
    counts = rows.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").collect()
    turn: dict[int, int] = {}
    for i, (length, n) in enumerate(counts):
        turn[length] = n
        full = sum(turn.values())
        if i + 1 < len(counts) and full + counts[i + 1]["n"] <= most:
            continue
        some = rows.where(F.col("length").isin(list(turn)))
        if full > most:
            some = some.orderBy(F.xxhash64("key"), "key").limit(most)
        found = some.select("length", "vector").toArrow()
        taken = {}
        for at, of in turn.items():
            x = matrix(found["vector"].filter(pc.equal(found["length"], at)))
            taken[at] = (of, np.unique(x, axis=0))
        yield taken
        turn = {}


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """A batch by the length of its vectors."""
    lengths = batch["length"].to_numpy()
    for length in np.unique(lengths):
        yield int(length), batch.filter(pa.array(lengths == length))


def met(residents: DataFrame, visits: DataFrame, find: Callable[[pa.Table, pa.Table], pa.Table], schema: str, purpose: str) -> DataFrame:
    """What ``find`` makes of the residents and visitors of each cell (length, cell).

    A cell's residents and visitors are dealt into parts of RESIDENTS and VISITORS, and every two
    parts meet in a group of their own: no task sees a whole cell. The number of tasks follows the
    number of groups.
    """
    cell = ["length", "cell"]
    stay = residents.groupBy(*cell).agg(F.ceil(F.count("*") / RESIDENTS).cast("int").alias("_parts"))
    come = visits.groupBy(*cell).agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("_calls"))
    sizes = materialise(stay.join(come, cell), f"{purpose}-cells")
    groups = sizes.agg(F.sum(F.col("_parts").cast("long") * F.col("_calls"))).first()[0] or 0
    tasks = int(min(MOST_TASKS, max(1, math.ceil(groups / GROUPS_A_TASK))))
    dealt = lambda key, n: F.pmod(F.xxhash64(key, F.lit(29)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    at_home = residents.join(sizes, cell).withColumn("part", dealt("uid", F.col("_parts"))).withColumn("call", every("_calls"))
    on_visit = visits.join(sizes, cell).withColumn("call", dealt("query", F.col("_calls"))).withColumn("part", every("_parts"))
    own, asked = [c for c in residents.columns if c not in cell], [c for c in visits.columns if c not in cell]
    one = at_home.select(*GROUP, F.struct(*own).alias("_resident"))
    two = on_visit.select(*GROUP, F.struct(*asked).alias("_visitor"))
    members = one.unionByName(two, allowMissingColumns=True).repartition(tasks, *GROUP)

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sides = []
        for name, names in (("_resident", own), ("_visitor", asked)):
            column = table[name].combine_chunks()
            column = column.filter(column.is_valid())
            sides.append(pa.Table.from_arrays(column.flatten(), names=names))
        return find(*sides)

    return members.groupBy(*GROUP).applyInArrow(meet, schema)
