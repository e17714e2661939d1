from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from tests.conftest import DATA
from tests.llm.cases import TEXTS, none, odd
from tickloom.llm.mixing import mix, mixed_documents, source_targets


def filled(sizes, weights):
    """Targets by sharing the excess again and again."""
    total, target, fixed = sum(sizes.values()), {}, set()
    while True:
        open_ = [s for s in sizes if s not in fixed]
        rest = total - sum(3 * sizes[s] for s in fixed)
        share = {s: rest * weights[s] / sum(weights[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        target = {**{s: 3.0 * sizes[s] for s in fixed}, **share}
        if not above:
            return target
        fixed |= above


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 5, 7], [1, 1, 1, 10000], [0, 5, 9], [7], [3, 3, 300, 3, 3, 1]])
def test_targets_against_resharing(spark, sizes):
    given = {f"s{i}": n for i, n in enumerate(sizes)}
    got = source_targets(spark.createDataFrame(list(given.items()), "source string, source_size long"))
    want = filled(given, {s: i % 3 + 1 for i, s in enumerate(sorted(given))})
    assert {r["source"]: r["target"] for r in got.collect()} == pytest.approx(want)


def test_shares_hold_and_partitioning_does_not_matter(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    a = mix(docs, columns=["doc_id", "source"], rows_per_range=37).collect()
    b = mix(docs.repartition(7, "n_chars"), columns=["doc_id", "source"]).collect()
    assert sorted(a) == sorted(b)
    taken, target, longest = Counter(), {}, defaultdict(int)
    for r in a:
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    assert sum(taken.values()) <= sum(r["size"] for r in a)
    assert all(abs(taken[s] - target[s]) <= 2 * max(longest.values()) for s in target)
    assert abs(sum(target.values()) - sum(r["size"] for r in a)) < 1e-6 * sum(target.values())


def test_odd_rows(spark):
    docs = odd(spark)
    got = mix(docs, columns=["doc_id", "text"]).collect()
    assert len(got) == len(TEXTS) and all(r["size"] == len((r["text"] or "").split()) for r in got)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    mixed = mixed_documents(docs)
    assert mixed.schema == docs.schema
    copies = sum(r["taken"] // r["size"] for r in got if r["size"])
    assert abs(mixed.count() - copies) == 0
    assert mix(none(spark)).count() == 0 and mixed_documents(none(spark)).count() == 0
