from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tickloom.llm.language as m
from tests.conftest import DATA
from tests.llm.cases import TEXTS, none, odd
from tickloom.llm.language import FEATURES, UNKNOWN, features, identify, support_vector_machine, train, with_language
from tickloom.llm.queries import op1_language_id


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    return train(docs, per_language=100)


def test_held_out_accuracy(spark):
    sf = f"{DATA}/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_language_id(spark, sf).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and len(held) > 100
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_play_no_part(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    for name, df in (("a", docs), ("b", changed)):
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
    a, b = (sorted(op1_language_id(spark, str(tmp_path / n)).collect()) for n in ("a", "b"))
    assert a == b


def brute(text):
    data = text.encode()
    x = np.zeros(FEATURES)
    for i in range(len(data)):
        key = 0
        for n in range(1, 5):
            if i + n <= len(data):
                key = (key * 257 + data[i + n - 1] + 1) % 2**32
                h = (key * 2654435761 % 2**32) ^ (n * 0x9E3779B1 % 2**32)
                h = (h ^ (h >> 15)) * 2246822519 % 2**32
                x[h >> 20] += 1
    x = np.sqrt(x)
    return x / max(np.linalg.norm(x), 1e-9)


@pytest.mark.parametrize("chunk", [1 << 20, 64])
def test_features_against_counting(monkeypatch, chunk):
    monkeypatch.setattr(m, "CHUNK_BYTES", chunk)
    rng = random.Random(1)
    texts = ["", "a", "über uns", *("".join(rng.choice("abcde üñ") for _ in range(rng.randrange(500))) for _ in range(20)), ""]
    got = np.vstack([x for _, _, x in features(pa.array(texts))])
    assert np.allclose(got, [brute(t) for t in texts], atol=1e-6)


def test_machine_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 10))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0, 1.0, -1.0)
    w, b = support_vector_machine(x, y)
    assert ((x @ w + b > 0) == (y > 0)).mean() > 0.97


def test_odd_rows(spark, learned):
    got = identify(odd(spark), learned, columns=["doc_id", "text"]).collect()
    assert len(got) == len(TEXTS)
    assert all((r["lang_pred"] == UNKNOWN and r["score"] == 0) == (not any(c.isalpha() for c in r["text"] or "")) for r in got)
    kept = with_language(odd(spark), learned, least_score=0)
    assert kept.schema == odd(spark).schema and kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in TEXTS)
    assert identify(none(spark), learned).count() == 0


def test_nothing_or_one_language_learned(spark):
    docs = odd(spark)
    nothing = train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in identify(docs, nothing).collect()} == {UNKNOWN}
    one = train(docs)
    assert {r["lang_pred"] for r in identify(docs, one).collect()} == {UNKNOWN, "en"}
    many = train(docs.withColumn("lang", F.element_at(F.array(F.lit("ru"), F.lit("zz"), F.lit("de-AT")), (F.length(F.coalesce("text", F.lit(""))) % 3 + 1).cast("int"))))
    assert set(many.languages) == {"ru", "zz", "de-AT"} and len(many.machines) == 3
