from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from tests.llm.cases import TEXTS, none, odd
from tickloom.llm.exact_dedup import CuckooFilter, build_index, delete_from_index, drop_copies, exact_dedup


def test_filter_against_a_set_with_deletions_and_resizing():
    rng, index, live = random.Random(5), CuckooFilter(1), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(4000)]
    for step in range(20000):
        key = rng.choice(keys)
        if key in live and rng.random() < 0.4:
            assert index.delete(key)
            del live[key]
        elif key not in live:
            assert index.slot(key) is None
            index.insert(key, step)
            live[key] = step
    assert index.live == len(live) and index.resizes > 3
    assert all((index.slot(k) is not None) == (k in live) for k in keys)
    assert all(index.values[index.slot(k)] == v for k, v in live.items())
    assert not index.delete(hashlib.sha256(b"never").digest())


def test_equal_fingerprints_are_told_apart_by_stored_keys():
    index = CuckooFilter(1)
    same = [bytes(8) + b"\x00\x07" + bytes(8) + bytes([i]) * 14 for i in range(30)]
    for k in same[:8]:
        assert index.slot(k) is None
        index.insert(k)
    assert all(index.slot(k) is not None for k in same[:8]) and index.slot(same[9]) is None


def test_odd_rows(spark):
    got = exact_dedup(odd(spark), columns=["doc_id", "text"]).collect()
    assert len(got) == len(TEXTS)
    groups = defaultdict(list)
    for r in got:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")].append(r)
    for text, members in groups.items():
        ids = [m["doc_id"] for m in members if m["doc_id"] is not None]
        assert {m["keep_id"] for m in members} == {min(ids) if ids else None}
        assert {m["group_size"] for m in members} == {len(members)}
        assert [m["doc_id"] for m in members if m["kept"]] == [min(ids) if ids else None]
        assert {m["text_sha256"] for m in members} == {hashlib.sha256(text.encode()).hexdigest()}


def test_columns_and_empty_tables(spark):
    docs = odd(spark)
    kept = drop_copies(docs)
    assert kept.schema == docs.schema and kept.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in TEXTS})
    assert exact_dedup(docs).columns.count("kept") == 1
    assert drop_copies(none(spark)).count() == 0 and exact_dedup(none(spark)).count() == 0


def test_deleted_digests_are_no_longer_live(spark):
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(500)]
    entries = spark.createDataFrame([(bytearray(k), False, i, i, 1) for i, k in enumerate(keys)], "digest binary, missing boolean, id long, uid long, rows long")
    live = build_index(entries, 3)
    gone = spark.createDataFrame([(bytearray(k),) for k in keys[::7] + [hashlib.sha256(b"never").digest()]], "digest binary")
    left = {bytes(r["digest"]) for r in delete_from_index(live, gone, 3).collect()}
    assert left == {k for i, k in enumerate(keys) if i % 7}
