"""Near-duplicate vectors by an inverted multi-index.

The halves of the vectors have codebooks of their own; the pairs of centroids form a grid of cells,
and every vector is filed in the cell of its nearest centroids. Search walks the cells of a vector in
the order of a lower bound of the distance to anything filed there, by the multi-sequence algorithm
over the two sorted lists of bounds, until the bound passes the reach that the target recall needs.
All vectors met in a cell are verified by their cosine.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import shared_folder
from tickloom.llm.common import col, components, materialise, packed, with_results

SAMPLE = 20_000
MOST_CENTROIDS = 512
RESIDENTS, VISITORS = 2048, 4096


def usable(rows: DataFrame) -> DataFrame:
    """Rows (uid, id, vector) with a key for equal vectors; the key is null for vectors that can't be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for vector in batch["vector"]:
                key = None
                if vector.is_valid and vector.values.null_count == 0:
                    v = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    if len(v) and np.isfinite(v).all() and np.abs(v).max() > 0:
                        key = hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest()
                keys.append(key)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "key"])

    schema = rows.selectExpr("*", "unhex('') key").schema
    return rows.mapInArrow(run, schema)


def units(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision; large and tiny ones are scaled first."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of k-means from evenly spaced rows in the order of the sample."""
    centroids = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = squared(x, centroids).argmin(axis=1)
        n = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return np.unique(centroids, axis=0)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] - 2.0 * x @ centroids.T + (centroids * centroids).sum(axis=1)[None, :])


def bounds(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid, and squared distances below which nothing filed under each centroid lies.

    Whatever is nearest to centroid i lies beyond the plane halfway between i and x's own centroid.
    """
    d = squared(x, centroids)
    home = d.argmin(axis=1)
    gap = np.sqrt(squared(centroids, centroids))[home]
    return home, ((d - d[np.arange(len(x)), home][:, None]) / (2.0 * np.where(gap > 0, gap, 1.0))) ** 2


def spread(x: np.ndarray) -> float:
    """Share of a squared difference that lies across a plane between centroids of a half, at least 1 / dimensions.

    Planes and differences are taken to lie as the vectors do: in few dimensions if these matter only.
    """
    length = x.shape[1]
    if len(x) < 2:
        return 1.0
    centred = x - x.mean(axis=0)
    total, out = (centred * centred).mean(axis=0).sum(), 1.0 / length
    for half in (centred[:, : length // 2], centred[:, length // 2 :]):
        moments = half.T @ half / len(x)
        if total > 0 and (own := np.trace(moments)) > 0:
            out = max(out, (moments * moments).sum() / (own * total))
    return float(min(1.0, out))


def multi_sequence(one: np.ndarray, two: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Cells (i, j) in the order of one[i] + two[j], as far as ``reach``."""
    p, q = one.argsort(), two.argsort()
    heap, seen, out = [(one[p[0]] + two[q[0]], 0, 0)], {(0, 0)}, []
    while heap and heap[0][0] <= reach:
        _, i, j = heapq.heappop(heap)
        out.append((int(p[i]), int(q[j])))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(p) and b < len(q) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (one[p[a]] + two[q[b]], a, b))
    return out


def filed(classes: DataFrame, books: tuple[np.ndarray, np.ndarray], reach: float) -> DataFrame:
    """Classes with their home cell and the cells that they visit."""
    half, width = books[0].shape[1], len(books[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = units(batch["vector"])
            (a, one), (b, two) = bounds(x[:, :half], books[0]), bounds(x[:, half:], books[1])
            visits = [[i * width + j for i, j in multi_sequence(s, t, reach)] for s, t in zip(one, two)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(a * width + b, pa.int64()), pa.array(visits, pa.list_(pa.int64()))], [*batch.schema.names, "home", "visits"])

    return classes.mapInArrow(run, classes.selectExpr("*", "0L home", "array(0L) visits").schema)


def compared(index: DataFrame, least: float) -> DataFrame:
    """Rows (key, links, label): links that each visit found, and edges that join what is linked.

    A cell's residents and its visitors are dealt into parts of RESIDENTS and VISITORS; every two
    parts meet in a group. A group yields a row a member, not a row a pair.
    """
    stay = index.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("r"))
    visit = index.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.count("*").alias("v"))
    parts = stay.join(visit, "cell").select("cell", F.ceil(F.col("r") / RESIDENTS).cast("int").alias("r"), F.ceil(F.col("v") / VISITORS).cast("int").alias("v"))
    part = lambda n: F.pmod(F.xxhash64("key", F.lit(13)), n).cast("int")
    residents = index.withColumn("cell", F.col("home")).join(parts, "cell").withColumn("rp", part(F.col("r"))).withColumn("vp", F.explode(F.expr("sequence(0, v - 1)")))
    visitors = index.withColumn("cell", F.explode("visits")).join(parts, "cell").withColumn("vp", part(F.col("v"))).withColumn("rp", F.explode(F.expr("sequence(0, r - 1)")))
    members = residents.select("cell", "rp", "vp", F.lit(True).alias("resident"), "key", "n", "vector", "home", "visits")
    members = members.unionByName(visitors.select("cell", "rp", "vp", F.lit(False).alias("resident"), "key", "n", "vector", "home", F.lit(None).cast("array<bigint>").alias("visits")))

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        home = table["resident"].to_numpy()
        x, n, keys = units(table["vector"].combine_chunks()), table["n"].to_numpy(), table["key"].to_pylist()
        names = {k: i for i, k in enumerate(sorted(set(keys)))}
        of = np.array([names[k] for k in keys], np.int64)
        r, v = of[home], of[~home]
        at, to = np.nonzero((x[~home] @ x[home].T >= least) & (v[:, None] != r[None, :]))
        # The visitor counts its link here; the resident counts it too unless its own visit does.
        links = np.zeros(len(names), np.int64)
        np.add.at(links, v[at], n[home][to])
        visits, cells = table["visits"].filter(table["resident"]).to_pylist(), table["home"].to_numpy()[~home]
        walks = {t: set(visits[t]) for t in set(to.tolist())}
        only = np.array([cells[a] not in walks[t] for a, t in zip(at.tolist(), to.tolist())], bool)
        np.add.at(links, r[to[only]], n[~home][at[only]])
        label = np.arange(len(names))
        a, b = v[at], r[to]
        while len(a):
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == before).all():
                break
        order = np.array(sorted(names, key=names.get) or [b""], object)
        some = np.flatnonzero((links > 0) | (label != np.arange(len(names))))
        return pa.table({"key": pa.array(order[some], pa.binary()), "links": pa.array(links[some], pa.int64()), "label": pa.array(order[label[some]], pa.binary())})

    return members.groupBy("cell", "rp", "vp").applyInArrow(meet, "key binary, links long, label binary")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    columns: list[str] | None = None,
    least: float = 0.95,
    deviations: float = 4.5,
    rows_per_cell: int = 500,
) -> DataFrame:
    """Link vectors whose cosine is at least ``least``, and find the components of the links.

    Returns ``columns`` (all by default), then n_links (other rows linked directly), component_id
    (smallest id reachable, itself included) and kept (true for one row of each component).

    * A vector that is null, empty, zero, or holds nulls or non-finite numbers links with nothing.
      Vectors of different lengths are never compared. Lengths of too few vectors for a second
      centroid are one cell each, all filed in one pass, so there may be any number of them; each
      other length has codebooks of its own.
    * Equal vectors are one class, filed once, and count as links of each other.
    * A null id sorts after all others; component_id is null where no row has an id. Of rows that
      repeat the smallest id, one is kept.
    * An empty table gives an empty result. A result takes the place of an input column of its name.

    Recall: two vectors at the least cosine differ by sqrt(2 - 2 * least); across a plane by that times
    sqrt(spread) times a standard normal number, where the spread is estimated from the sample: 1 /
    dimensions if vectors have no preferred direction, more if few dimensions matter. A pair is found if either vector visits the other's cell, so each walks half of ``deviations`` of
    these, and never beyond the whole difference. Every row is filed. Codebooks are learned from a sample of at most SAMPLE different vectors, on
    the driver, with at most MOST_CENTROIDS centroids each.
    """
    names = vectors.columns if columns is None else columns
    vector = col(vector_col)
    if vectors.schema[vector_col].dataType.simpleString() != "array<float>":
        vector = vector.cast("array<double>")
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"), col(id_col).alias("id"), vector.alias("vector"), packed(vectors, names).alias("row")
    )
    known = materialise(usable(rows), "vectors")
    classes = known.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.first("vector").alias("vector"))
    classes = materialise(classes.withColumn("length", F.size("vector")), "vector-classes")
    counts = classes.groupBy("length").agg(F.count("*").alias("of_length")).withColumn("of", F.col("length")).drop("length")
    many = counts.where(F.col("of_length") >= 4 * rows_per_cell)
    path = shared_folder(vectors.sparkSession, "vector-links")
    few = classes.join(many, F.col("length") == F.col("of"), "left_anti").withColumn("home", F.col("length").cast("long"))
    compared(few.withColumn("visits", F.array("home")).drop("length"), least).write.parquet(path)
    for length, n in many.select("of", "of_length").toLocalIterator():
        some = classes.where(F.col("length") == length).select("key", "n", "vector")
        most = 2.0 - 2.0 * least
        k = max(1, min(MOST_CENTROIDS, math.isqrt(n // rows_per_cell)))
        sample = some.orderBy(F.xxhash64("key")).limit(SAMPLE).select("vector").toArrow()["vector"].combine_chunks()
        x = units(sample)
        reach = min(1.0, (deviations / 2.0) ** 2 * spread(x)) * most
        books = (codebook(x[:, : length // 2], k), codebook(x[:, length // 2 :], k))
        index = materialise(filed(some, books, reach * 1.000001), "vector-index")
        compared(index, least).write.mode("append").parquet(path)
    found = vectors.sparkSession.read.schema("key binary, links long, label binary").parquet(path)
    groups = components(found.select(F.col("key").alias("a"), F.col("label").alias("b")))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    about = classes.select("key", "n").join(links, "key", "left").join(groups.withColumnRenamed("node", "key"), "key", "left")
    about = about.select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "key").alias("component"))
    labelled = known.join(about, "key")
    reps = labelled.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "uid")).alias("rep"))
    done = labelled.join(reps, "component").select("row", "n_links", F.col("rep.id").alias("component_id"), (F.col("uid") == F.col("rep.uid")).alias("kept"))
    alone = known.where("key is null").select("row", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return with_results(done.unionByName(alone), "row", names, {c: F.col(c) for c in ("n_links", "component_id", "kept")})
