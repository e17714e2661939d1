from __future__ import annotations

import random

import numpy as np
import pytest

from tests.conftest import DATA
from tickloom.llm.embeddings import bounds, codebook, multi_sequence, near_duplicates, squared
from tickloom.llm.queries import op4_embedding_dedup


def brute(ids, x, least=0.95):
    """n_links and component of each id by comparing all pairs."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= least
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        new = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == label).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, near.sum(axis=1), label)}
        label = new


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_whole_table_against_all_pairs(spark, sf):
    rows = spark.read.parquet(f"{DATA}/sf{sf}/embeddings.parquet").collect()
    want = brute([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], np.float64))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in op4_embedding_dedup(spark, f"{DATA}/sf{sf}").collect()}
    assert got == want


def test_recall_at_the_threshold_with_many_cells(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(1500, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    shift = rng.normal(size=base.shape)
    shift -= (shift * base).sum(axis=1, keepdims=True) * base
    shift /= np.linalg.norm(shift, axis=1, keepdims=True)
    c = rng.uniform(0.9501, 0.96, size=(1500, 1))
    x = np.vstack([base, c * base + np.sqrt(1 - c * c) * shift])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = brute(list(range(3000)), x)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(df, columns=["vec_id"], rows_per_cell=10).collect()}
    found = sum(got[i] == want[i] for i in want)
    assert sum(n for n, _ in want.values()) >= 3000 and found / len(want) > 0.99
    assert all(got[i][0] <= want[i][0] for i in want)


def test_large_groups_are_split(spark, monkeypatch):
    import tickloom.llm.embeddings as m

    monkeypatch.setattr(m, "RESIDENTS", 40)
    monkeypatch.setattr(m, "VISITORS", 60)
    rng = np.random.default_rng(5)
    x = rng.normal(size=16) + 0.05 * rng.normal(size=(300, 16))
    x = np.vstack([x, x[:5], x[:5], rng.normal(size=(40, 16))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(df, columns=["vec_id"], rows_per_cell=20).collect()}
    assert got == brute(list(range(len(x))), x)


def test_walk_is_in_order_and_complete():
    rng = random.Random(6)
    one, two = (np.array([rng.random() for _ in range(n)]) for n in (7, 9))
    cells = multi_sequence(one, two, 0.8)
    cost = [one[i] + two[j] for i, j in cells]
    assert cost == sorted(cost) and set(cells) == {(i, j) for i in range(7) for j in range(9) if one[i] + two[j] <= 0.8}


def test_bounds_hold():
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(200, 8)), rng.normal(size=(500, 8))
    book = codebook(x, 12)
    _, low = bounds(x, book)
    at = squared(y, book).argmin(axis=1)
    d = ((x[:, None] - y[None]) ** 2).sum(axis=2)
    assert (d >= low[:, at] - 1e-9).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]),
        (8, [nan, 1.0, 0.0]), (9, [inf, 1.0, 0.0]), (10, [1.0, 0.0]), (11, [1.0]), (12, [5.0]), (None, [1.0, 0.0, 0.0]), (None, [0.0, 1.0, 0.0]), (13, [1e300, 1e300, 0.0]), (14, [1e-300, 1e-300, 0.0]), (1, [1.0, 0.0, 0.0]), (15, [-1.0, 0.0, 0.0]), (16, [-0.0, 1.0]),
    ]
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], "vec_id long, embedding array<double>, key string, n string, home string")
    got = sorted(((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()), key=str)
    want = [(False, 1, 4, 1, True), (False, 1, 4, 1, False), (False, 2, 4, 1, False), (False, 3, 4, 1, False), (True, 0, 4, 1, False), (True, 0, 0, None, True), (False, 13, 1, 13, True), (False, 14, 1, 13, False), (False, 11, 1, 11, True), (False, 12, 1, 11, False)]
    want += [(False, i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 15, 16)]
    assert got == sorted(want, key=str)
    assert near_duplicates(df.limit(0)).count() == 0


def test_recall_where_few_dimensions_matter(spark):
    rng = np.random.default_rng(11)
    axes = np.linalg.qr(rng.normal(size=(256, 24)))[0].T
    base = rng.normal(size=(1500, 24))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    shift = rng.normal(size=base.shape)
    shift -= (shift * base).sum(axis=1, keepdims=True) * base
    shift /= np.linalg.norm(shift, axis=1, keepdims=True)
    x = np.vstack([base, 0.951 * base + np.sqrt(1 - 0.951**2) * shift]) @ axes
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = brute(list(range(3000)), x)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(df, columns=["vec_id"], rows_per_cell=10).collect()}
    assert sum(n for n, _ in want.values()) >= 3000 and sum(got[i] == want[i] for i in want) / len(want) > 0.99


def test_any_number_of_lengths(spark):
    rng = np.random.default_rng(12)
    rows = [v for length in range(1, 61) for v in (rng.normal(size=length), -np.ones(length), np.ones(length), 3 * np.ones(length))]
    rows += list(rng.normal(size=(200, 40)))
    got = near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>"), columns=["vec_id"], rows_per_cell=30)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got.collect()}
    want = {}
    for length in {len(v) for v in rows}:
        ids = [i for i, v in enumerate(rows) if len(v) == length]
        want |= brute(ids, np.array([rows[i] for i in ids]))
    assert got == want
