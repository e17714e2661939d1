from __future__ import annotations

import gzip
import random

import pyarrow.fs as pfs
import pytest
from pyspark.sql import functions as F

from tickloom.llm.warc import base32_sha1, read_warc, resolved, write_warc

PAGES = "page_id long, url string, html string, payload string, kind string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def trip(spark, df, split=32 << 20, **how):
    return read_warc(spark, write_warc(df, **how), split_bytes=split)


@pytest.mark.parametrize("split", [50, 997, 1 << 20])
def test_round_trip_at_any_split(spark, split):
    rng = random.Random(split)
    rows = [(i, f"http://h/{i}?q=ü\n{i}", "".join(rng.choice("abc <p>é\r\n") for _ in range(rng.randrange(3000)))) for i in range(60)]
    back = trip(spark, pages(spark, rows).repartition(4, "page_id"), split, file_bytes=20_000).collect()
    assert sorted((int(r["page_id"]), r["url"], bytes(r["payload"]).decode()) for r in back) == sorted(rows)


def test_revisits(spark):
    rows = [(5, "u5", "same"), (2, "u2", "same"), (9, "u9", "same"), (1, "u1", ""), (3, None, None), (4, "u4", "other"), (None, "u", "same"), (None, "n", "alone"), (2, "u2", "same")]
    got = resolved(trip(spark, pages(spark, rows))).collect()
    assert len(got) == len(rows)
    seen = sorted((r["page_id"] or "", r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got)
    same, empty = base32_sha1(b"same"), base32_sha1(b"")
    assert seen == sorted(
        [
            ("5", "revisit", "2", 4, same),
            ("2", "response", None, 4, same),
            ("2", "response", None, 4, same),
            ("9", "revisit", "2", 4, same),
            ("", "revisit", "2", 4, same),
            ("", "response", None, 5, base32_sha1(b"alone")),
            ("1", "response", None, 0, empty),
            ("3", "revisit", "1", 0, empty),
            ("4", "response", None, 5, base32_sha1(b"other")),
        ],
        key=lambda r: r,
    )
    short = trip(spark, pages(spark, rows), least=5).collect()
    assert {r["record_type"] for r in short} == {"response"}


def test_archives_inside_pages_false_magic_and_long_pages(spark):
    inner = "\x1f\x8b\x08 WARC/1.1 \r\n\r\n"
    rows = [(0, "a", inner * 500), (1, "b", "x" * 3_000_000), (2, "c", "".join(random.Random(1).choice("0123456789abcdef") for _ in range(200_000)))]
    back = trip(spark, pages(spark, rows), 1000).collect()
    assert sorted((int(r["page_id"]), bytes(r["payload"]).decode()) for r in back) == [(i, h) for i, _, h in rows]


def test_files_are_plain_gzip_members_and_junk_is_skipped(spark, tmp_path):
    files = write_warc(pages(spark, [(1, "u", "text")]))
    path = files.first()["path"]
    fs, name = pfs.FileSystem.from_uri(path)
    data = fs.open_input_file(name).read()
    text = gzip.decompress(data)
    assert text.startswith(b"WARC/1.1\r\n") and b"\r\n\r\ntext\r\n\r\n" in text
    junk = tmp_path / "junk.warc.gz"
    junk.write_bytes(b"\x1f\x8b\x08junk" + gzip.compress(b"no record") + data + b"\x1f\x8b\x08\x00" + data[: len(data) // 2])
    listed = spark.createDataFrame([(str(junk), junk.stat().st_size), (None, 3)], "path string, bytes long")
    assert [r["page_id"] for r in read_warc(spark, listed, 7).collect()] == ["1"]


def test_ranges_are_read_by_as_many_tasks(spark):
    files = write_warc(pages(spark, [(i, "u", random.Random(i).randbytes(2000).hex()) for i in range(40)]).coalesce(1))
    ranges = sum(-(-r["bytes"] // 1000) for r in files.collect())
    back = read_warc(spark, files, 1000)
    assert back.rdd.getNumPartitions() == ranges > 40 and back.count() == 40
    used = back.select(F.spark_partition_id().alias("task")).distinct().count()
    assert used > 15
    few = read_warc(spark, files, 1000, max_tasks=3)
    assert few.rdd.getNumPartitions() == 3 and few.count() == 40


def test_empty_table(spark):
    assert resolved(trip(spark, pages(spark, []))).count() == 0
