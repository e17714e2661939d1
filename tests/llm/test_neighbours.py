from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tickloom.llm import neighbours
from tickloom.llm.neighbours import coded, estimated, nearest, rotated
from tickloom.llm.queries import op13_nearest


def brute(ids, x, asks, k=20):
    out = {}
    for q in np.flatnonzero([asks(i) for i in ids]):
        score = x @ x[q]
        score[q] = -np.inf
        order = np.lexsort((ids, -score))[: min(k, len(ids) - 1)]
        out[int(ids[q])] = [(int(ids[j]), score[j]) for j in order]
    return out


def by_query(rows, name="id"):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r[name], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) for q, near in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_whole_table_against_all_pairs(spark, sf):
    rows = spark.read.parquet(f"{DATA}/sf{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    want, got = brute(ids, x, lambda i: i % 20 == 0), by_query(op13_nearest(spark, f"{DATA}/sf{sf}").collect(), "vec_id")
    assert got.keys() == want.keys() and all(len(got[q]) == len(want[q]) for q in want)
    assert recall(got, want) > 0.99
    place = {i: n for n, i in enumerate(ids)}
    for q, near in got.items():
        assert [s for _, s in near] == pytest.approx([x[place[i]] @ x[place[q]] for i, _ in near], rel=1e-12)


def test_bounds_hold_and_leave_most_rows_out():
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(4000, 96)), rng.normal(size=(50, 96))
    centre = x.mean(axis=0)
    estimate, error = estimated(coded(x, np.repeat(centre[None, :], len(x), axis=0)), centre, q, 4.0)
    true = q @ x.T
    assert (np.abs(true - estimate) <= error).mean() > 0.9999
    bar = np.sort(true, axis=1)[:, -20][:, None]
    assert (estimate + error >= bar).mean() < 0.5 and np.abs((estimate - true).mean()) < 0.02
    turned = rotated(x)
    assert np.allclose((turned * turned).sum(axis=1), (x * x).sum(axis=1), rtol=1e-4)


@pytest.mark.parametrize("length", [5, 200])
def test_recall_on_clusters_of_different_lengths(spark, length, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS_A_LIST", 60)
    rng = np.random.default_rng(length)
    x = 3 * rng.normal(size=(20, length))[rng.integers(20, size=1500)] + rng.normal(size=(1500, length))
    x *= rng.uniform(0.1, 3, size=(1500, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = brute(np.arange(1500), x, lambda i: i % 20 == 0)
    assert recall(by_query(nearest(df, F.col("vec_id") % 20 == 0).collect()), want) > 0.99


def test_lists_that_cannot_reach_the_score_are_not_walked(spark):
    rng = np.random.default_rng(7)
    book = 50 * np.eye(10)
    x = np.repeat(book, 40, axis=0) + rng.normal(size=(400, 10))
    rows = spark.createDataFrame([(f"q{i}", 10, v.tolist(), 2000.0) for i, v in enumerate(x[::40])], "query string, length int, vector array<double>, least double")
    reach = {(10, c): (20.0, 6.0) for c in range(10)}
    cells = neighbours.walked(rows, {10: book}, reach).select("query", "cell").collect()
    assert sorted(cells) == [(f"q{i}", i) for i in range(10)]


def test_a_hot_vector_ties_and_parts(spark, monkeypatch):
    import tickloom.llm.vectors as m

    monkeypatch.setattr(m, "RESIDENTS", 30)
    monkeypatch.setattr(m, "VISITORS", 7)
    rng = np.random.default_rng(8)
    x = np.vstack([np.tile(rng.normal(size=16), (150, 1)), rng.normal(size=(300, 16))])
    ids = rng.permutation(450)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>").repartition(4)
    got, want = by_query(nearest(df, F.col("vec_id") % 5 == 0).collect()), brute(ids, x, lambda i: i % 5 == 0)
    assert recall(got, want) > 0.99
    hot = int(ids[np.flatnonzero(ids[:150] % 5 == 0)[0]])
    assert [i for i, _ in got[hot]] == sorted(i for i in ids[:150] if i != hot)[:20]


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, query string, rank int, uid string, score string"
    rng = np.random.default_rng(9)
    good = [(i, rng.normal(size=4).tolist()) for i in range(30)]
    bad = [(40, None), (50, []), (60, [0.0] * 4), (70, [1.0, None, 1.0, 1.0]), (80, [float("nan"), 1.0, 1.0, 1.0]), (90, [float("inf"), 1.0, 1.0, 1.0])]
    more = [(None, [9.0, 9.0, 9.0, 9.0]), (100, [1.0]), (110, [1.0] * 2), (110, [1.0] * 2)]
    more += [(200 + 20 * i + j, [1.0 + j] * (10 + i)) for i in range(20) for j in range(3)]
    df = spark.createDataFrame([(i, v, "x", 1, "x", "x") for i, v in good + bad + more], schema)
    got = by_query(nearest(df, F.col("vec_id") % 20 == 0, k=3).collect())
    assert set(got) == {0, 20, *(200 + 20 * i for i in range(20))}
    assert [i for i, _ in got[220]] == [222, 221]
    x = np.array([v for _, v in good], np.float32).astype(np.float64)
    want = {q: near for q, near in brute(np.arange(30), x, lambda i: i % 20 == 0, 29).items()}
    for q in (0, 20):
        own = [(i, s) for i, s in want[q]] + [(None, 9 * x[q].sum())]
        assert [i for i, _ in got[q]] == [i for i, _ in sorted(own, key=lambda p: -p[1])[:3]]
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    twice = by_query(nearest(df.where("vec_id = 110"), F.col("vec_id") == 110).collect()[:1])
    assert twice == {110: [(110, 2.0)]}
