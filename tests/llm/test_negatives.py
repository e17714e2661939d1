from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import differences
from tests.conftest import DATA
from tickloom.llm import negatives
from tickloom.llm.negatives import Tree, file, grow, hard_negatives, reached
from tickloom.llm.oracle import ORACLE
from tickloom.llm.queries import op11_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, query string, cell string, uid string, rank string"


def brute(rows, anchor=lambda i: i % 10 == 0, positives=5, negatives=5, scale=256):
    """Rows from (id, vector, label) by comparing every pair; equal scores go by id, then by vector."""
    known = [(i, [int(np.floor(scale * x)) for x in v], lab, n) for n, (i, v, lab) in enumerate(rows) if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, v, lab, n in known:
        if i is None or not anchor(i):
            continue
        others = sorted((-dot(v, w), j is None, j or 0, m, other == lab) for j, w, other, m in known if m != n and len(w) == len(v))
        for at, none, p, *_ in [o for o in others if o[4]][:positives]:
            fits = [o for o in others if not o[4] and 80 * -at <= 100 * -o[0] <= 100 * -at][:negatives]
            out += [(i, None if none else p, r, None if o[1] else o[2], -at, -o[0]) for r, o in enumerate(fits, 1)]
    return sorted(out, key=str)


def found(df, anchor=None, **options):
    anchor = F.col("vec_id") % 10 == 0 if anchor is None else anchor
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, hard_negatives(df, anchor, **options).select(*names).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, *["x"] * 5) for i, v, lab in rows], SCHEMA).repartition(3)


def clustered(n=400, length=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, length))
    return [(i, (centres[rng.integers(12)] + 0.2 * rng.normal(size=length)).tolist(), int(rng.integers(3))) for i in range(n)]


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_whole_table_against_sql(spark, sf):
    assert differences(op11_hard_negatives(spark, f"{DATA}/sf{sf}"), ORACLE["op11_hard_negatives"], f"{DATA}/sf{sf}")[:3] == []


def test_clusters_against_all_pairs_with_many_small_leaves(spark, monkeypatch):
    monkeypatch.setattr(negatives, "grow", lambda sample, rows: grow(sample, rows, ways=4, rows_a_leaf=6))
    rows = clustered()
    assert found(frame(spark, rows)) == brute(rows)


def test_subtrees_outside_the_annulus_are_left_out_and_hold_nothing():
    rng = np.random.default_rng(2)
    centres = 40 * rng.normal(size=(30, 6))
    x = np.floor(256 * (centres[rng.integers(30, size=3000)] + rng.normal(size=(3000, 6))))
    tree = grow(np.unique(x[:1000], axis=0), len(x), ways=6, rows_a_leaf=40)
    leaf, tree.ranges = file(tree, x)
    seen = 0
    for q in x[::100]:
        scores = x @ q
        low, high = np.sort(scores)[[-60, -20]]
        leaves = reached(tree, q, np.array([[low, high]]))
        assert set(leaf[(scores >= low) & (scores <= high)]) <= set(leaves)
        seen += len(leaves)
    assert len(leaves) == len(set(leaves)) and seen < 0.3 * tree.leaves * len(x[::100])


def test_a_hot_leaf_is_dealt_into_parts(spark, monkeypatch):
    import tickloom.llm.vectors as m

    monkeypatch.setattr(m, "RESIDENTS", 30)
    monkeypatch.setattr(m, "VISITORS", 7)
    rows = clustered(200)
    rows += [(1000 + i, [0.5] * 8, i % 2) for i in range(150)]
    assert found(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).tolist(), i % 2) for i in range(40)]
    rows += [(50, None, 1), (60, [1.0, None, 2.0], 1), (70, [float("nan"), 0.0, 0.0], 0), (80, [float("inf"), 0.0, 0.0], 0), (90, [1.0, 1.0, 1.0], None)]
    rows += [(100, [0.0, 0.0, 0.0], 1), (110, [], 0), (120, [], 1), (None, [1.0, 1.0, 1.0], 1), (None, [2.0, 2.0, 2.0], 0)]
    rows += [(200 + i, (i % 20 + 1) * [0.5 + i / 100], i % 2) for i in range(60)]
    rows += [(300, [1.0] * 50, 0), (301, [1.0] * 50, 0), (None, [0.9] * 50, 1)]
    got, want = found(frame(spark, rows)), brute(rows)
    assert got == want and any(r[3] is None for r in got)
    twice = frame(spark, [(10, [1.0, 0.0], 0), (10, [1.0, 0.0], 0), (11, [0.9, 0.0], 1), (11, [0.9, 0.0], 1)])
    assert found(twice) == [(10, 10, r, 11, 65536, 58880) for r in (1, 1, 2, 2)]
    assert found(frame(spark, [])) == [] and found(frame(spark, rows), F.lit(None).cast("boolean")) == []


def test_a_tree_of_equal_rows_is_one_leaf():
    tree = grow(np.ones((50, 3)), 10_000)
    assert tree.leaves == 1 and tree.points == [] and isinstance(tree, Tree)
