"""Hard negatives by exact search in a GNAT: a tree of multiway hyperplanes with distance ranges.

Every node has some split points, far from each other; a row goes with the nearest, so hyperplanes
halfway between the points bound the subtrees. For each split point and each of its siblings'
subtrees the node keeps the range of distances from the point to the rows of the subtree, and the
range of their lengths. A search asks for scores within a window; with the lengths of a subtree this is
an annulus of distances around the anchor. Whatever a split point's range, shifted by the anchor's
distance to that point, leaves of the annulus decides whether the subtree is walked. Leaves that
remain are compared exactly.

The tree is grown from a bounded sample on the driver; all rows are filed in it, and its ranges are
minima and maxima over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, materialise
from tickloom.llm.vectors import by_length, finite, firsts, matrix, met, name_of, samples

WAYS = 16
ROWS_A_LEAF = 1024
LEAST_A_LEAF = 4
SEEDS = 4
#: Relative slack of distances, far above the rounding of whole numbers in double precision.
SLACK = 1e-9
#: What is asked without windows: any score.
EVERY = ({"low": -np.inf, "high": np.inf},)


@dataclass
class Tree:
    """Split points and children of every node; a child is a node, or a leaf as -1 - leaf."""

    points: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 1
    ranges: dict[int, tuple[np.ndarray, ...]] = field(default_factory=dict)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] - 2.0 * x @ points.T + (points * points).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(0.0, d))


def spread_out(x: np.ndarray, ways: int) -> np.ndarray:
    """Split points: each next one is the row farthest from those taken, among some evenly spaced rows."""
    x = x[np.linspace(0, len(x) - 1, min(len(x), 20 * ways)).astype(int)]
    taken, near = [0], distances(x, x[:1])[:, 0]
    while len(taken) < ways and near.max() > 0:
        taken.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[taken[-1:]])[:, 0])
    return x[taken]


def grow(sample: np.ndarray, rows: int, ways: int = WAYS, rows_a_leaf: int = ROWS_A_LEAF) -> Tree:
    """A tree over different sample rows whose leaves will hold about ``rows_a_leaf`` of ``rows`` rows."""
    capacity = max(LEAST_A_LEAF, math.ceil(rows_a_leaf * len(sample) / max(rows, 1)))
    tree, leaves = Tree(), 0
    todo: list[tuple[np.ndarray, int, int]] = [(sample, -1, 0)]
    while todo:
        x, parent, way = todo.pop()
        # Points too close for their distances to tell them apart stay in one leaf.
        points = spread_out(x, min(ways, math.ceil(len(x) / capacity))) if len(x) > capacity else x[:1]
        if len(points) == 1:
            child, leaves = -1 - leaves, leaves + 1
        else:
            child = len(tree.points)
            tree.points.append(points)
            tree.children.append([0] * len(points))
            near = distances(x, points).argmin(axis=1)
            todo.extend((x[near == i], child, i) for i in range(len(points)))
        if parent >= 0:
            tree.children[parent][way] = child
    tree.leaves = leaves
    return tree


def file(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, ...]]]:
    """The leaf of every row, and the ranges that these rows give the nodes they pass."""
    leaf, ranges = np.zeros(len(x), np.int64), {}
    lengths = (x * x).sum(axis=1)
    todo = [(0, np.arange(len(x)))] if tree.points else []
    while todo:
        node, rows = todo.pop()
        d = distances(x[rows], tree.points[node])
        near, k = d.argmin(axis=1), len(tree.points[node])
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        short, long = np.full(k, np.inf), np.full(k, -np.inf)
        for j in np.unique(near):
            own = near == j
            low[:, j], high[:, j] = d[own].min(axis=0), d[own].max(axis=0)
            short[j], long[j] = lengths[rows[own]].min(), lengths[rows[own]].max()
            child = tree.children[node][j]
            if child < 0:
                leaf[rows[own]] = -1 - child
            else:
                todo.append((child, rows[own]))
        ranges[node] = (low, high, short, long)
    return leaf, ranges


def seeds(tree: Tree, q: np.ndarray, most: int = SEEDS) -> list[int]:
    """The leaf of an anchor and the nearest ones beside it."""
    node = 0
    while tree.points:
        d = distances(q[None, :], tree.points[node])[0]
        order = d.argsort(kind="stable")
        child = tree.children[node][order[0]]
        if child < 0:
            return [-1 - c for c in (tree.children[node][i] for i in order) if c < 0][:most]
        node = child
    return [0]


def reached(tree: Tree, q: np.ndarray, windows: np.ndarray) -> list[int]:
    """Leaves that may hold a row whose product with ``q`` lies in one of the windows (lowest, highest)."""
    if not tree.points:
        return [0]
    out, todo, own = [], [0], float(q @ q)
    while todo:
        node = todo.pop()
        if node not in tree.ranges:
            continue
        low, high, short, long = tree.ranges[node]
        d = distances(q[None, :], tree.points[node])[0]
        there = long >= short
        short, long = np.where(there, short, 0.0), np.where(there, long, 0.0)
        nearest = np.maximum(0.0, np.maximum(d[:, None] - high, low - d[:, None]).max(axis=0))
        farthest = (d[:, None] + high).min(axis=0)
        inner = np.sqrt(np.maximum(0.0, own + short[None, :] - 2.0 * windows[:, 1:]))
        outer = own + long[None, :] - 2.0 * windows[:, :1]
        slack = SLACK * (1.0 + own + long)
        outer = np.where(outer + slack >= 0, np.sqrt(np.maximum(0.0, outer) + slack), -1.0)
        meets = (nearest[None, :] * (1 - SLACK) <= outer) & (farthest[None, :] * (1 + SLACK) + np.sqrt(slack) >= inner)
        for j in np.flatnonzero(meets.any(axis=0) & there):
            child = tree.children[node][j]
            if child < 0:
                out.append(-1 - child)
            else:
                todo.append(child)
    return out


def filed(rows: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Rows with their leaf as ``cell``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some in by_length(batch):
                leaf, _ = file(trees[length], matrix(some["vector"]))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(leaf, pa.int64())], [*some.schema.names, "cell"])

    return rows.mapInArrow(run, rows.selectExpr("*", "0L cell").schema)


def ranged(index: DataFrame, trees: dict[int, Tree]) -> dict[int, Tree]:
    """The trees with the ranges of all rows of the index: as many numbers as split points times siblings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            for length, some in by_length(batch):
                _, ranges = file(trees[length], matrix(some["vector"]))
                for node, new in ranges.items():
                    old = all_.setdefault((length, node), list(new))
                    for i, pick in enumerate((np.minimum, np.maximum, np.minimum, np.maximum)):
                        old[i] = pick(old[i], new[i])
        for (length, node), (low, high, short, long) in all_.items():
            k = len(short)
            low, high = np.vstack([low, short]), np.vstack([high, long])
            i, j = np.divmod(np.arange(k * (k + 1)), k)
            columns = [np.full(i.shape, length), np.full(i.shape, node), i, j]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array(low.ravel()), pa.array(high.ravel())], ["length", "node", "i", "j", "low", "high"])

    parts = index.select("length", "vector").mapInArrow(run, "length long, node long, i long, j long, low double, high double")
    for length, node, i, j, low, high in parts.groupBy("length", "node", "i", "j").agg(F.min("low"), F.max("high")).collect():
        tree = trees[length]
        k = len(tree.points[node])
        if node not in tree.ranges:
            tree.ranges[node] = (np.full((k, k), np.inf), np.full((k, k), -np.inf), np.full(k, np.inf), np.full(k, -np.inf))
        own = tree.ranges[node]
        if i < k:
            own[0][i, j], own[1][i, j] = low, high
        else:
            own[2][j], own[3][j] = low, high
    return trees


def walked(queries: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Queries once for each leaf they must see: by their windows, or the seeds of those without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some in by_length(batch):
                x, tree, windows = matrix(some["vector"]), trees[length], some["windows"].to_pylist()
                cells = [seeds(tree, q) if w is None else reached(tree, q, np.array([(p["low"], p["high"]) for p in w]).reshape(-1, 2)) for q, w in zip(x, windows)]
                rows = np.repeat(np.arange(len(some)), [len(c) for c in cells])
                yield pa.RecordBatch.from_arrays([*some.take(pa.array(rows)).columns, pa.array([c for own in cells for c in own], pa.int64())], [*some.schema.names, "cell"])

    return queries.mapInArrow(run, queries.selectExpr("*", "0L cell").schema)


def scored(residents: pa.Table, visitors: pa.Table, same: bool, first: int) -> pa.Table:
    """Of each visitor and window the first residents of the same label, or of others, in the order of score and id."""
    by_id = pc.sort_indices(residents.append_column("_nothing", pc.is_null(residents["id"])), [("_nothing", "ascending"), ("id", "ascending"), ("uid", "ascending")])
    residents = residents.take(by_id)
    labels = pa.chunked_array([*residents["label"].chunks, *visitors["label"].chunks], residents["label"].type).combine_chunks().dictionary_encode().indices.to_numpy()
    mine, asked = labels[: len(residents)], labels[len(residents) :]
    q = matrix(visitors["vector"])
    x = matrix(residents["vector"]).reshape(len(residents), -1 if len(residents) else q.shape[1])
    windows = visitors["windows"].to_pylist()
    rows: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(q), 128):
        scores = q[begin : begin + 128] @ x.T
        asks = [np.array([(p["low"], p["high"]) for p in w or EVERY]).reshape(-1, 2) for w in windows[begin : begin + 128]]
        lowest, highest = (np.array([f(w[:, k]) for w in asks])[:, None] for k, f in ((0, np.min), (1, np.max)))
        of, at = np.nonzero(((asked[begin : begin + 128, None] == mine[None, :]) == same) & (scores >= lowest) & (scores <= highest))
        down = -scores[of, at]
        order = np.lexsort((down, of))
        at, down, ends = at[order], down[order], np.searchsorted(of, np.arange(len(asks) + 1))
        for i, w in enumerate(asks):
            own = down[ends[i] : ends[i + 1]]
            starts = np.searchsorted(own, -w[:, 1], "left")
            stops = np.minimum(starts + first, np.searchsorted(own, -w[:, 0], "right"))
            for k in np.flatnonzero(stops > starts):
                some = slice(ends[i] + starts[k], ends[i] + stops[k])
                rows.append((np.full(at[some].shape, begin + i), np.full(at[some].shape, k), at[some], -down[some]))
    of, window, at, score = (np.concatenate(c) if rows else np.zeros(0, np.int64) for c in (zip(*rows) if rows else ([],) * 4))
    found = residents.select(["id", "uid"]).take(pa.array(at, pa.int64()))
    return pa.table({"query": visitors["query"].take(pa.array(of, pa.int64())), "window": pa.array(window, pa.int32()), "id": found["id"], "uid": found["uid"], "score": pa.array(score, pa.float64())})


def searched(index: DataFrame, queries: DataFrame, trees: dict[int, Tree], same: bool, first: int) -> DataFrame:
    """Rows (query, window, id, uid, score): the first of each query and window."""
    visits = materialise(walked(queries, trees), "negatives-visits")
    residents = index.select("length", "cell", "uid", "id", "label", "vector")
    kind = index.schema["id"].dataType.simpleString()
    found = met(residents, visits, lambda r, v: scored(r, v, same, first), f"query string, window int, id {kind}, uid long, score double", "negatives")
    return firsts(found, ["query", "window"], first, score=True)


def window(low: Column, high: Column) -> Column:
    return F.struct(low.cast("double").alias("low"), high.cast("double").alias("high"))


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    most_percent: int = 100,
    scale: int = 256,
) -> DataFrame:
    """Of every anchor and each of its first positives, the first rows of other labels that score nearly as high.

    Components become floor(scale * x); a score is the whole inner product. Positives of an anchor are its
    ``positives`` other rows of the same label of the highest score; negatives of a positive are rows
    of other labels with least_percent * positive <= 100 * score <= most_percent * positive, the
    ``negatives`` highest. Equal scores go by the smaller id. Returns (anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score), rank from 1 for the negatives of a pair.

    * Rows with a null label, a null vector, or any null or non-finite component take no part; vectors
      of different lengths never meet, however many lengths there are. Zero vectors take part.
    * A null id sorts after all others. Rows that repeat an id are rows of their own, in a fixed order.
    * A negative positive score has no negatives, as its window is empty. Pairs without any have no rows.
    * An empty table, or no anchor, gives an empty result. Other columns of ``rows`` are ignored.
    * Products are exact below 2 ** 53: scaled components saturate at sqrt(2 ** 53 / length), which
      for 64 dimensions and a scale of 256 is a component of 46,000.

    Of rows with equal vector and label only the first positives + 1 can ever be returned, so the index
    holds no more of them, and equal anchors search once. Every search is exact.
    """
    most = F.floor(F.sqrt(F.lit(float(1 << 53)) / F.greatest(F.size(col(vector_col)), F.lit(1)))).cast("double")
    vector = F.transform(F.transform(col(vector_col).cast("array<double>"), lambda x: F.floor(F.least(F.greatest(F.lit(float(scale)) * x, -most), most))), lambda x: x.cast("int"))
    fits = finite(col(vector_col).cast("array<double>")) & col(label_col).isNotNull()
    known = rows.where(fits).select(
        F.monotonically_increasing_id().alias("uid"), col(id_col).alias("id"), col(label_col).alias("label"), vector.alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor")
    )
    known = known.select("*", F.size("vector").alias("length"), name_of(F.col("vector")).alias("key"))
    known = known.withColumn("query", F.md5(F.concat_ws(":", "key", F.col("label").cast("string"))))
    known = materialise(known, "negatives-rows")
    few = materialise(firsts(known, ["query"], max(positives + 1, negatives)).drop("anchor"), "negatives-few")
    asked = known.where("anchor").groupBy("query").agg(*[F.first(c).alias(c) for c in ("length", "label", "vector")])
    asked = materialise(asked, "negatives-anchors")

    near = far = None
    for turn in samples(few.select("key", "length", "vector")):
        trees = {length: grow(sample, n) for length, (n, sample) in turn.items()}
        own = F.col("length").isin(list(trees))
        index = materialise(filed(few.where(own), trees), "negatives-index")
        trees = ranged(index, trees)
        queries = asked.where(own)
        unbound = queries.withColumn("windows", F.lit(None).cast("array<struct<low:double,high:double>>"))
        start = searched(index, unbound, trees, True, positives + 1)
        least = start.groupBy("query").agg(F.min("score").alias("low"), F.count("*").alias("n"))
        bound = F.array(window(F.when(F.col("n") > positives, F.col("low")).otherwise(-np.inf), F.lit(np.inf)))
        start = queries.join(least, "query").withColumn("windows", bound).drop("low", "n")
        first = materialise(searched(index, start, trees, True, positives + 1), "negatives-positives")
        near = first if near is None else near.unionByName(first)
        # Scores within the percentages: the ends are whole numbers, found exactly in double precision.
        share = lambda s, percent, up: F.floor((s.cast("long") * percent + (99 if up else 0)).cast("decimal(38,0)") / 100)
        ends = lambda s: window(share(s, least_percent, True), share(s, most_percent, False))
        scores = first.groupBy("query").agg(F.sort_array(F.collect_set("score"), False).alias("scores"))
        after = queries.join(scores, "query").withColumn("windows", F.transform("scores", ends))
        found = searched(index, after.drop("scores"), trees, False, negatives)
        found = found.join(scores, "query").withColumn("positive_score", F.expr("element_at(scores, window + 1)")).drop("scores", "window")
        found = materialise(found, "negatives-found")
        far = found if far is None else far.unionByName(found)
    if near is None:
        near = few.selectExpr("query", "0 window", "id", "uid", "0D score").limit(0)
        far = near.drop("window").withColumn("positive_score", F.lit(0.0))
    # All first positives of an anchor's class, at most one more than wanted: the anchor itself goes.
    order = F.struct((-F.col("score")).alias("at"), F.col("id").isNull().alias("missing"), "id", "uid", "score")
    lists = near.groupBy("query").agg(F.sort_array(F.collect_list(order)).alias("near"))
    pairs = known.where("anchor").select("query", F.col("id").alias("anchor_id"), F.col("uid").alias("anchor")).join(lists, "query")
    pairs = pairs.withColumn("p", F.explode(F.slice(F.filter("near", lambda p: p["uid"] != F.col("anchor")), 1, positives)))
    pairs = pairs.select("query", "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    each = far.groupBy("query", "positive_score").agg(F.sort_array(F.collect_list(order)).alias("far"))
    out = pairs.join(each, ["query", "positive_score"]).select("anchor_id", "positive_id", "positive_score", F.posexplode("far").alias("rank", "f"))
    return out.select(
        "anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), F.col("f.id").alias("negative_id"), F.col("positive_score").cast("long").alias("positive_score"), F.col("f.score").cast("long").alias("negative_score")
    )
