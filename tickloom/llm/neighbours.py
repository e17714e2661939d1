"""Approximate nearest neighbours by inner product, from randomly rotated one-bit codes.

Vectors are filed under the nearest centroid of a small codebook. What is left of a vector beside its
centroid is turned by a random rotation (signs and Hadamard transforms, in more dimensions than it
had), and only the sign of each coordinate is kept, one bit. With three correction scalars (length of
the rest, its cosine with its own code, its product with the centroid) the bits give an unbiased
estimate of the inner product with a query, and a bound on the error that holds but for a chance set by
``deviations``. A first walk over the best lists gives each query a score that its last neighbour must
reach; a second walk over all lists that can reach it reranks by the true product whatever the upper
bound of the estimate doesn't rule out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, materialise
from tickloom.llm.embeddings import codebook
from tickloom.llm.vectors import by_length, finite, firsts, matrix, met, name_of, samples

ROWS_A_LIST = 65_536
FEWEST_LISTS, MOST_LISTS = 8, 1024
EXPANSION = 4
SEEDS = 2
TURNS = 3


def n_bits(length: int) -> int:
    """Bits of a code: a power of two, at least EXPANSION times the dimensions."""
    return 1 << max(6, math.ceil(math.log2(max(1, length) * EXPANSION)))


def rotated(x: np.ndarray, seed: int = 17) -> np.ndarray:
    """Rows turned by the same random rotation: random signs and a Hadamard transform, three times."""
    bits = n_bits(x.shape[1])
    y = np.zeros((len(x), bits), np.float32)
    y[:, : x.shape[1]] = x
    signs = np.random.default_rng(seed).choice(np.array([-1.0, 1.0], np.float32), (TURNS, bits))
    for turn in signs:
        y *= turn
        half = 1
        while half < bits:
            pairs = y.reshape(len(y), -1, 2, half)
            y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(y), bits)
            half *= 2
        y /= np.float32(math.sqrt(bits))
    return y


@dataclass
class Codes:
    """Packed signs of rotated rests, and what corrects their estimates."""

    bits: np.ndarray
    length: np.ndarray
    cosine: np.ndarray
    shift: np.ndarray


def coded(x: np.ndarray, centres: np.ndarray) -> Codes:
    """Codes of rows beside their centres."""
    rest = x - centres
    length = np.sqrt((rest * rest).sum(axis=1))
    y = rotated(rest / np.where(length > 0, length, 1.0)[:, None])
    cosine = np.abs(y).sum(axis=1, dtype=np.float64) / math.sqrt(y.shape[1])
    return Codes(np.packbits(y > 0, axis=1), length, np.where(length > 0, cosine, 1.0), (rest * centres).sum(axis=1))


def estimated(codes: Codes, centre: np.ndarray, q: np.ndarray, deviations: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of the products of queries with coded rows of one centre, and the bounds of their errors.

    <x, q> = <c, q> + <x - c, c> + <x - c, q - c>; only the last part is estimated, as the product of the
    rotated query with the code, over the cosine of the code with what it stands for. What the code
    misses is perpendicular to it, in a direction that the rotation makes random.
    """
    bits = codes.bits.shape[1] * 8
    signs = np.unpackbits(codes.bits, axis=1).astype(np.float32) * 2 - 1
    away = q - centre
    far = np.sqrt((away * away).sum(axis=1))
    raw = (rotated(away) @ signs.T).astype(np.float64) / math.sqrt(bits)
    estimate = (q @ centre)[:, None] + codes.shift[None, :] + raw * (codes.length / codes.cosine)[None, :]
    missed = np.sqrt(np.maximum(0.0, 1.0 - codes.cosine**2)) / codes.cosine
    # Single precision of the rotated query adds a little.
    error = far[:, None] * (codes.length * (deviations * missed / math.sqrt(bits - 1) + 1e-5))[None, :]
    return estimate, error + 1e-12 * np.abs(estimate)


def filed(rows: DataFrame, books: dict[int, np.ndarray]) -> DataFrame:
    """Rows with the list they are filed in as ``cell``, their code and its scalars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some in by_length(batch):
                x, book = matrix(some["vector"]), books[length]
                cell = ((book * book).sum(axis=1)[None, :] - 2.0 * x @ book.T).argmin(axis=1)
                codes = coded(x, book[cell])
                new = [pa.array(cell, pa.int64()), pa.array([b.tobytes() for b in codes.bits], pa.binary()), *[pa.array(c) for c in (codes.length, codes.cosine, codes.shift)]]
                yield pa.RecordBatch.from_arrays([*some.columns, *new], [*some.schema.names, "cell", "code", "rest", "cosine", "shift"])

    return rows.mapInArrow(run, rows.selectExpr("*", "0L cell", "unhex('') code", "0D rest", "0D cosine", "0D shift").schema)


def walked(queries: DataFrame, books: dict[int, np.ndarray], reach: dict[tuple[int, int], tuple[float, float]]) -> DataFrame:
    """Queries once for each list to see: the best ones of those without a score to reach, else all that can reach it.

    A row x of list c has <x, q> = <c, q> + <x - c, c> + <x - c, q - c>, so the largest shift and
    length of the list bound it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some in by_length(batch):
                q, book, least = matrix(some["vector"]), books[length], some["least"].to_pylist()
                there = [c for c in range(len(book)) if (length, c) in reach]
                centres, shift, rest = book[there], *np.array([reach[length, c] for c in there]).reshape(-1, 2).T
                near = q @ centres.T
                far = np.sqrt(np.maximum(0.0, (q * q).sum(axis=1)[:, None] - 2.0 * near + (centres * centres).sum(axis=1)[None, :]))
                highest = near + np.minimum(shift[None, :] + far * rest[None, :], np.sqrt((q * q).sum(axis=1))[:, None] * rest[None, :])
                cells = []
                for own, top, score in zip(near, highest, least):
                    at = np.argsort(-own, kind="stable")[:SEEDS] if score is None else np.flatnonzero(top * (1 + 1e-9 * np.sign(top)) + 1e-12 >= score)
                    cells.append([there[i] for i in at])
                rows = np.repeat(np.arange(len(some)), [len(c) for c in cells])
                yield pa.RecordBatch.from_arrays([*some.take(pa.array(rows)).columns, pa.array([c for own in cells for c in own], pa.int64())], [*some.schema.names, "cell"])

    return queries.mapInArrow(run, queries.selectExpr("*", "0L cell").schema)


def reranked(residents: pa.Table, visitors: pa.Table, centre: np.ndarray, k: int, deviations: float) -> pa.Table:
    """True scores of the rows that the bounds leave to each query, the first ``k`` of them."""
    missing = residents.append_column("_nothing", pc.is_null(residents["id"]))
    residents = residents.take(pc.sort_indices(missing, [("_nothing", "ascending"), ("id", "ascending"), ("uid", "ascending")]))
    q = matrix(visitors["vector"])
    x = matrix(residents["vector"]).reshape(len(residents), -1 if len(residents) else q.shape[1])
    bits = np.frombuffer(b"".join(residents["code"].to_pylist()), np.uint8).reshape(len(residents), -1 if len(residents) else 1)
    codes = Codes(bits, *(residents[c].to_numpy() for c in ("rest", "cosine", "shift")))
    least = np.array([-np.inf if v is None else v for v in visitors["least"].to_pylist()])
    rows: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(q) if len(x) else 0, 256):
        some = q[begin : begin + 256]
        estimate, error = estimated(codes, centre, some, deviations)
        bar = least[begin : begin + 256]
        if len(x) >= k:
            bar = np.maximum(bar, np.partition(estimate - error, len(x) - k, axis=1)[:, len(x) - k])
        for i, at in enumerate(map(np.flatnonzero, estimate + error >= bar[:, None])):
            score = (x[at] * some[i]).sum(axis=1)
            first = np.argsort(-score, kind="stable")[:k]
            rows.append((np.full(first.shape, begin + i), at[first], score[first]))
    of, at, score = (np.concatenate(c) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
    found = residents.select(["id", "uid"]).take(pa.array(at, pa.int64()))
    return pa.table({"query": visitors["query"].take(pa.array(of, pa.int64())), "id": found["id"], "uid": found["uid"], "score": pa.array(score, pa.float64())})


def searched(index: DataFrame, queries: DataFrame, books: dict[int, np.ndarray], reach: dict, k: int, deviations: float) -> DataFrame:
    """Rows (query, id, uid, score): the first ``k`` of each query in the lists it walks."""
    visits = materialise(walked(queries, books, reach), "neighbours-visits")
    residents = index.select("length", "cell", "uid", "id", "vector", "code", "rest", "cosine", "shift", F.struct("length", "cell").alias("at"))

    def find(r: pa.Table, v: pa.Table) -> pa.Table:
        at = r["at"][0].as_py() if len(r) else {"length": 0, "cell": 0}
        centre = books[at["length"]][at["cell"]] if len(r) else np.zeros(0)
        return reranked(r, v, centre, k, deviations)

    kind = index.schema["id"].dataType.simpleString()
    return firsts(met(residents, visits, find, f"query string, id {kind}, uid long, score double", "neighbours"), ["query"], k, score=True)


def nearest(
    rows: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    deviations: float = 4.0,
) -> DataFrame:
    """The ``k`` other rows of the largest inner product with each query row, found through one-bit codes.

    ``queries`` says which rows are queries; candidates are all rows but the query's own. Returns
    (query_id, rank, id, score): rank from 1, nearest first, equal scores by the smaller id; the score is
    the product of the original vectors in double precision. With fewer candidates a query has them all.

    * Vectors that are null, empty, zero, or hold null or non-finite components take no part. Vectors of
      different lengths never meet, however many lengths there are.
    * A null id sorts after all others; rows that repeat an id are rows of their own, in a fixed order.
    * An empty table, or no query, gives an empty result. Other columns of ``rows`` are ignored.

    Every row is filed and coded; the codebook is learned from at most 20,000 vectors. A neighbour is missed
    only if its estimate errs by more than ``deviations`` standard deviations, and lists are left out
    only if none of their rows can reach the query's score. Of equal vectors only the first k + 1 can
    be returned, so the index holds no more of them, and equal queries search once.
    """
    vector = col(vector_col)
    if rows.schema[vector_col].dataType.simpleString() != "array<float>":
        vector = vector.cast("array<double>")
    fits = finite(vector) & F.exists(vector, lambda x: x != 0)
    known = rows.where(fits).select(F.monotonically_increasing_id().alias("uid"), col(id_col).alias("id"), vector.alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    known = materialise(known.select("*", F.size("vector").alias("length"), name_of(F.col("vector")).alias("query")), "neighbours-rows")
    few = materialise(firsts(known, ["query"], k + 1).drop("asks").withColumnRenamed("query", "key"), "neighbours-few")
    asked = known.where("asks").groupBy("query").agg(F.first("length").alias("length"), F.first("vector").alias("vector"))
    asked = materialise(asked.withColumn("least", F.lit(None).cast("double")), "neighbours-queries")

    found = None
    for turn in samples(few):
        books = {length: codebook(sample, max(FEWEST_LISTS, min(MOST_LISTS, n // ROWS_A_LIST))) for length, (n, sample) in turn.items()}
        own = F.col("length").isin(list(books))
        index = materialise(filed(few.where(own), books), "neighbours-index")
        about = index.groupBy("length", "cell").agg(F.max("shift").alias("shift"), F.max("rest").alias("rest"))
        reach = {(r["length"], r["cell"]): (r["shift"], r["rest"]) for r in about.collect()}
        start = searched(index, asked.where(own), books, reach, k + 1, deviations)
        least = start.groupBy("query").agg(F.min("score").alias("score"), F.count("*").alias("n"))
        bound = asked.where(own).join(least, "query", "left").withColumn("least", F.when(F.col("n") > k, F.col("score")).otherwise(F.lit(float("-inf"))))
        best = materialise(searched(index, bound.drop("score", "n"), books, reach, k + 1, deviations), "neighbours-found")
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = few.selectExpr("key query", "id", "uid", "0D score").limit(0)
    order = F.struct((-F.col("score")).alias("at"), F.col("id").isNull().alias("missing"), "id", "uid", "score")
    lists = found.groupBy("query").agg(F.sort_array(F.collect_list(order)).alias("near"))
    answers = known.where("asks").select("query", F.col("id").alias("query_id"), F.col("uid").alias("own")).join(lists, "query")
    answers = answers.select("query_id", F.posexplode(F.slice(F.filter("near", lambda p: p["uid"] != F.col("own")), 1, k)).alias("rank", "p"))
    return answers.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("p.id").alias("id"), F.col("p.score").alias("score"))
