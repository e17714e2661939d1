from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.cases import TEXTS, none, odd
from tickloom.llm.sharding import scatter, shuffle_into_shards, write_shards


def check(rows, n, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    sizes = [len(by[s]) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_law_and_randomness(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    rows = shuffle_into_shards(docs, columns=["doc_id", "text", "source"], bucket_bytes=200_000).collect()
    check(rows, 1000, 24)
    assert sorted(r["doc_id"] for r in rows) == list(range(1000))
    for r in rows:
        data = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    rising = sum(a < b for a, b in zip(order, order[1:]))
    assert 430 < rising < 570 and max(Counter(i // 42 for i in order[:42]).values()) < 12
    again = shuffle_into_shards(docs, columns=["doc_id"], bucket_bytes=200_000).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in rows} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


def test_written_shards(spark, tmp_path):
    docs = odd(spark)
    done = shuffle_into_shards(docs, shards=4, id_col="doc_id", columns=["doc_id", "text"])
    write_shards(done, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    check(back.collect(), len(TEXTS), 4)
    assert sorted(map(str, back.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))


def test_odd_rows(spark):
    docs = odd(spark)
    check(shuffle_into_shards(docs).collect(), len(TEXTS), 24)
    hot = docs.crossJoin(spark.range(50)).drop("id")
    check(shuffle_into_shards(hot, bucket_bytes=100_000).collect(), 50 * len(TEXTS), 24)
    assert shuffle_into_shards(none(spark)).count() == 0


def test_the_seed_alone_fixes_the_order(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text")
    equal = spark.range(600).selectExpr("cast(null as long) doc_id", "'the same text in very many rows' text")
    docs = docs.unionByName(equal).unionByName(equal.selectExpr("7 doc_id", "text"))
    found = [shuffle_into_shards(d, bucket_bytes=20_000).collect() for d in (docs, docs.repartition(7), docs.orderBy("text").coalesce(2))]
    shown = [sorted((str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in rows) for rows in found]
    assert shown[0] == shown[1] == shown[2]
    check(found[0], docs.count(), 24)
    spread = Counter(r["shard"] for r in found[0] if r["doc_id"] is None)
    assert len(spread) == 24 and max(spread.values()) < 3 * min(spread.values()) + 30


def test_equal_rows_are_dealt_evenly(spark):
    hot = spark.range(3000).selectExpr("cast(null as long) doc_id", "repeat('word ', 20) text")
    rows, buckets = scatter(hot, ["doc_id"], "doc_id", "text", 17, 20_000)
    n = [r["n"] for r in rows.groupBy("bucket").agg(F.count("*").alias("n")).collect()]
    assert len(n) == buckets > 10 and max(n) < 1.5 * 3000 / buckets
