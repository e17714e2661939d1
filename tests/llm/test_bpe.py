from __future__ import annotations

import hashlib
import re

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tests.conftest import DATA
from tests.llm.cases import TEXTS, none, odd
from tickloom.llm.bpe import blocks_of, decode, encode, read_ranks
from tickloom.llm.queries import RANKS, bpe_digests

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokens():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


def test_whole_table_against_the_library(spark, tokens):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = bpe_digests(docs, ["doc_id"]).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = tokens.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_small_blocks_and_buckets_change_nothing(spark, tokens):
    texts = [(i, f" it's  {i}\n\n\t words and more 'll \x1c\x85 {'x' * i} {i * 977}") for i in range(80)] + TEXTS
    docs = odd(spark, texts)
    back = decode(encode(docs, RANKS, PATTERN, columns=["doc_id", "text"], block_bytes=300, bucket_bytes=100), RANKS).collect()
    assert len(back) == len(texts)
    for r in back:
        assert r["ids"] == tokens.encode_ordinary(r["text"] or "") and bytes(r["decoded"]).decode() == (r["text"] or "")


def test_columns_and_empty_tables(spark):
    docs = odd(spark)
    out = decode(encode(docs, RANKS, PATTERN), RANKS)
    assert out.columns == [c for c in docs.columns if c != "ids"] + ["ids", "decoded"] and out.count() == len(TEXTS)
    assert decode(encode(none(spark), RANKS, PATTERN), RANKS).count() == 0


def test_decoding_of_nulls_and_unknown_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "n int, ids array<int>")
    got = {r["n"]: r["decoded"] for r in decode(df, RANKS, slice_ids=1).collect()}
    table = {i: t for t, i in read_ranks(RANKS).items()}
    assert got == {1: None, 2: b"", 3: table[0] + table[1]}
    with pytest.raises(Exception, match="table of token bytes|out of bounds"):
        decode(spark.createDataFrame([([999999],)], "ids array<int>"), RANKS).collect()


def test_pre_tokens_are_listed_alike_without_positions(spark):
    lines = spark.createDataFrame([(i, f"a{i % 3} b a{i} {'c ' * (i % 5)}" if i % 7 else "") for i in range(60)], "row int, text string").coalesce(2)

    def use(number, check, words, docs, row):
        yield pa.RecordBatch.from_pylist([{"number": number, "check": check, "words": [w.decode() for w in words], "positions": sum(map(len, docs)), "n": len(row)}])

    with_blocks = blocks_of(lines, PATTERN, 100)
    schema = "number long, check long, words array<string>, positions long, n long"
    full, light = (sorted(with_blocks(use, schema, positions=p).collect()) for p in (True, False))
    assert [r[:3] + r[4:] for r in full] == [r[:3] + r[4:] for r in light] and len(full) > 5
    assert all(r["positions"] for r in full) and not any(r["positions"] for r in light)


def test_ids_reach_python_in_parts(spark):
    table = {i: t for t, i in read_ranks(RANKS).items()}
    rows = [(i, None if i % 9 == 8 else [(i * 31 + j) % 5000 for j in range((0, 1, 3, 4, 5, 40, 2)[i % 7])]) for i in range(60)]
    df = spark.createDataFrame(rows, "n int, ids array<int>").coalesce(2)
    assert re.search(r"MapInArrow.*\n.*slice\(.*\n.*Generate explode", decode(df, RANKS)._jdf.queryExecution().optimizedPlan().toString())
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    try:
        spark.conf.set(batch, "3")
        for part_ids, slice_ids in ((1, 1), (4, 6), (4, 1 << 18), (128, 1)):
            got = [(r["n"], r["ids"], r["decoded"]) for r in decode(df, RANKS, slice_ids=slice_ids, part_ids=part_ids).collect()]
            assert sorted(got) == [(n, ids, None if ids is None else b"".join(map(table.get, ids))) for n, ids in rows]
    finally:
        spark.conf.set(batch, before)
