"""The pipeline against brute force, stage by stage on what each stage was given."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import tiktoken

import corpus_pipeline
from tests.conftest import DATA
from tests.llm.cases import SCHEMA, none, odd, rows
from tests.llm.test_minhash import brute
from tickloom.llm.bpe import read_ranks
from tickloom.llm.common import placed
from tickloom.llm.queries import RANKS


def test_every_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    kept, rows = {}, [docs.collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, f"{DATA}/sf0.001")
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows.append(docs.collect())
        kept[name] = rows[-1]
    ids = [sorted(r["doc_id"] for r in x) for x in rows]
    assert len(ids[1]) >= 0.97 * sum(any(c.isalpha() for c in r["text"] or "") for r in rows[0])

    groups = defaultdict(list)
    for r in rows[1]:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r["text"])].append(r["doc_id"])
    assert ids[2] == sorted(map(min, groups.values()))

    own = brute([(r["doc_id"], r["text"]) for r in rows[2]], 80)
    assert ids[3] == sorted({c for n, c in own if n})

    times, size = Counter(ids[4]), {r["doc_id"]: len(r["text"].split()) for r in rows[3]}
    assert set(times) <= set(ids[3]) and max(times.values()) <= 3
    budget = sum(size.values())
    assert budget - max(size.values()) <= sum(size[i] * n for i, n in times.items()) <= budget

    tokens = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    text = {r["doc_id"]: r["text"] for r in rows[0]}
    assert ids[5] == ids[4]
    for r in rows[5]:
        assert r["ids"] == tokens.encode_ordinary(text[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_stages_take_odd_rows_and_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd(spark), none(spark)):
            n = stage(spark, docs, "").count()
            assert n <= 3 * docs.count(), name


def test_stored_texts_are_not_written_to_scratch_tables(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(200)) for _ in range(400)]
    spark.createDataFrame(rows([(i, t) for i, t in enumerate([*texts, *texts[:50]])]), SCHEMA).repartition(3, "doc_id").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    of = lambda folder: {p: p.stat().st_size for p in folder.rglob("*.parquet")}
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    whole = sum(of(tmp_path / "docs").values())
    for name in ("exact_dedup", "near_dedup", "mix_sources"):
        before = of(shared)
        dict(corpus_pipeline.STAGES)[name](spark, docs, "").write.parquet(str(tmp_path / name))
        new = {p: n for p, n in of(shared).items() if p not in before and "minhash-texts" not in str(p)}
        assert new and sum(new.values()) < whole / 2, name


def test_rows_that_share_a_place_in_a_file_are_told_apart(spark, tmp_path):
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(9))) for i in range(6)]
    spark.createDataFrame(rows(texts), SCHEMA).coalesce(1).write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    twice = stored.crossJoin(spark.range(2).withColumnRenamed("id", "n")).drop("n")
    assert placed(stored, "once").schema["uid"].dataType.simpleString() == "struct<file:string,place:bigint>"
    assert placed(twice, "twice").select("uid").distinct().count() == 12
    for name in ("exact_dedup", "near_dedup"):
        stage = dict(corpus_pipeline.STAGES)[name]
        for docs in (stored, twice, stored.unionByName(stored)):
            assert sorted(r["doc_id"] for r in stage(spark, docs, "").collect()) == list(range(6)), name


def test_tasks_that_decode_have_one_python_worker(spark):
    plan = corpus_pipeline.encode_bpe(spark, odd(spark), "")._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"\w+In(?:Arrow|Pandas)", plan) == ["MapInArrow"]
