from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import DATA
from tests.llm.cases import TEXTS, none, odd
from tickloom.llm.minhash import distinct_shingles, drop_near_duplicates, near_duplicates, shingle_set, sketches

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words_of(text):
    return " ".join(w for w in (text or "").translate(UPPER).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w)


def brute(rows, percent):
    """(n, component) by comparing all pairs."""
    sets = [shingle_set(words_of(t)) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    top[max(a, b)] = min(a, b)
    ids = {}
    for i, (key, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(key)
    return [(len(sets[i]), min((k for k in ids[find(i)] if k is not None), default=None)) for i in range(len(rows))]


@pytest.mark.parametrize("percent", [80, 85])
def test_whole_table_against_all_pairs(spark, percent):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    want = {r[0]: w for r, w in zip(rows, brute(rows, percent))}
    got = near_duplicates(docs, columns=["doc_id"], percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_families_near_the_threshold(spark):
    rng, texts = random.Random(11), []
    for f in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(30, 200))]
        texts += family(rng, base, 25, max(2, len(base) // 40))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    want = {r[0]: w for r, w in zip(rows, brute(rows, 85))}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs, columns=["doc_id"], percent=85).collect()}
    assert got == want


def test_sketches_fill_and_estimate():
    rng = random.Random(2)
    for size in (1, 2, 7, 100, 3000):
        a = [f"w{rng.random()}" for _ in range(size + 4)]
        doc, hashes = distinct_shingles(pa.array([" ".join(a), " ".join(a[: max(5, size // 2 + 4)]), ""]))
        s = sketches(doc, hashes, 3)
        assert (s[:2] < np.iinfo(np.uint64).max).all()
        n = np.bincount(doc, minlength=3)
        assert n[0] == size and n[2] == 0 and abs((s[0] == s[1]).mean() - n[1] / n[0]) < 0.17


def test_shingles_across_chunks(monkeypatch):
    texts = [" ".join(f"w{i * j % 977}" for i in range(300)) for j in range(1, 9)] + ["", "a", "a b c d", "ü é 日本 a b"]
    whole = [len(shingle_set(t)) for t in texts]
    import tickloom.llm.minhash as m

    plain = distinct_shingles(pa.array(texts))
    monkeypatch.setattr(m, "CHUNK_BYTES", 64)
    cut = distinct_shingles(pa.array(texts))
    assert (plain[0] == cut[0]).all() and (plain[1] == cut[1]).all()
    assert np.bincount(plain[0], minlength=len(texts)).tolist() == whole


def test_odd_rows(spark):
    docs = odd(spark)
    got = near_duplicates(docs, columns=["doc_id", "text"]).collect()
    want = brute(TEXTS, 80)
    assert sorted((str(r["doc_id"]), r["text"] or "", r["n_shingles"], str(r["component_id"])) for r in got if r["n_shingles"]) == sorted(
        (str(i), t or "", n, str(c)) for (i, t), (n, c) in zip(TEXTS, want) if n
    )
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in got if not r["n_shingles"])
    kept = drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    assert kept.count() == sum(n == 0 for n, _ in want) + len({(c if c is not None else t) for (_, t), (n, c) in zip(TEXTS, want) if n}) + 1
    assert drop_near_duplicates(none(spark)).count() == 0 and near_duplicates(none(spark)).count() == 0


def test_texts_alike_below_the_threshold_stay_inside_their_blocks(spark, monkeypatch):
    import tickloom.llm.minhash as m

    monkeypatch.setattr(m, "BLOCK", 30)
    made = []
    real = m.materialise
    monkeypatch.setattr(m, "materialise", lambda df, purpose: made.append((purpose, real(df, purpose))) or made[-1][1])
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(150):
        w = list(base)
        for k in rng.sample(range(1, 15), 4):
            w[10 * k] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += [texts[3] + " end", texts[3] + " end of it"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    want = {r[0]: w for r, w in zip(rows, brute(rows, 85))}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in m.near_duplicates(docs, columns=["doc_id"], percent=85).collect()}
    assert got == want
    assert max(df.count() for purpose, df in made if purpose in ("minhash-links", "minhash-candidates")) < 12 * len(texts)


def test_components_of_a_long_path_settle(spark):
    from tickloom.llm.common import components

    order = list(range(300))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(i, 0) for i in range(300)}
