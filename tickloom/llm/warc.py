"""WARC archives: a writer with revisit records, and a reader that splits compressed files.

Each record is a gzip member of its own. A reading task owns a byte range: it looks for the magic
number of gzip, takes a candidate as a member only if it inflates to the headers of a record, and
reads every record that starts inside its range to its end, beyond the range if need be.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import shared_folder
from tickloom.llm.common import col, materialise

MAGIC = b"\x1f\x8b\x08"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:page:"
CHUNK = 1 << 20
MANIFEST = "path string, bytes long, records long"
READ = "page_id string, url string, record_type string, payload binary, payload_digest string, refers_to string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page: str | None, url: str | None, kind: str, refers_to: str | None, payload: bytes, digest: str, date: str) -> bytes:
    """One record as a gzip member. A revisit has headers only."""
    name = lambda x: f"<{RECORD}{'' if x is None else '=' + quote(x, safe='')}>"
    block = payload if kind == "response" else b""
    lines = [("WARC-Type", kind), ("WARC-Record-ID", name(page)), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        lines.append(("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=~-._")))
        lines.append(("WARC-Target-Text", quote(url, safe="")))
    if kind == "revisit":
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to))]
    lines += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def with_record_types(pages: DataFrame, id_col: str, html_col: str, url_col: str, least: int) -> DataFrame:
    """Rows (page, url, payload, digest, kind, refers_to).

    Of equal payloads of at least ``least`` bytes the row with the smallest id is the response. Equal
    payloads are found by SHA-1 and length; the minimum is combined before the shuffle.
    """
    payload = F.encode(F.coalesce(col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(col(id_col).alias("id"), col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("hash", F.sha1("payload")).withColumn("length", F.octet_length("payload"))
    first = rows.groupBy("hash", "length").agg(F.min(F.struct(F.col("id").isNull().alias("missing"), "id")).alias("first"))
    rows = rows.join(first, ["hash", "length"])
    response = (F.col("length") < least) | F.col("id").eqNullSafe(F.col("first.id"))
    return rows.select(
        F.col("id").cast("string").alias("page"),
        "url",
        "payload",
        F.when(response, "response").otherwise("revisit").alias("kind"),
        F.when(~response, F.col("first.id").cast("string")).alias("refers_to"),
    )


def write_warc(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    html_col: str = "html",
    url_col: str = "url",
    least: int = 0,
    file_bytes: int = 256 << 20,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row to compressed WARC files; returns the manifest (path, bytes, records).

    * A null page is an empty payload, an ordinary one. A null url has no target header.
    * A null id sorts after all others. Rows that repeat the smallest id of their payload are each
      written as a response, as a revisit must refer to another id.
    * An empty table gives an empty manifest. Other columns are not written.

    A task writes files under names of its own attempt and the manifest lists those of the attempt
    that Spark committed, so files of lost or repeated attempts are never read.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, root = FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        out, number, size, records = None, 0, 0, 0
        done: list[tuple[str, int, int]] = []

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append((f"{folder}/{name}", size, records))
                out = None

        for batch in batches:
            for page, url, payload, kind, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{number:03d}-{uuid.uuid4().hex[:8]}.warc.gz"
                    out, size, records, number = fs.open_output_stream(posixpath.join(root, name), compression=None), 0, 0, number + 1
                member = record_bytes(page, url, kind, refers_to, payload, base32_sha1(payload), date)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= file_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "bytes", "records"])

    return materialise(with_record_types(pages, id_col, html_col, url_col, least).mapInArrow(write, MANIFEST), "warc-manifest")


class _Window:
    """A forward-moving piece of a file; reads on in chunks as it is asked for more."""

    def __init__(self, source: pa.NativeFile, start: int) -> None:
        self.source, self.start, self.data, self.ended = source, start, bytearray(), False
        source.seek(start)

    def more(self) -> bool:
        got = self.source.read(CHUNK)
        self.ended = self.ended or not got
        self.data += got
        return bool(got)

    def drop(self, to: int) -> None:
        """Forget everything before an offset of the file."""
        del self.data[: to - self.start]
        self.start = to


def member_at(window: _Window, offset: int) -> tuple[bytes, int] | None:
    """The record in the gzip member at an offset and the member's end, or None if none starts there."""
    unpack = zlib.decompressobj(31)
    found, at, parts, known = 0, offset - window.start, [], False
    while not unpack.eof:
        piece = bytes(window.data[at : at + CHUNK])
        if not piece:
            if not window.more():
                return None
            continue
        at += len(piece)
        try:
            plain = unpack.decompress(piece)
        except zlib.error:
            return None
        parts.append(plain)
        found += len(plain)
        if not known and found >= len(VERSION):
            head = b"".join(parts)
            if not head.startswith(b"WARC/1."):
                return None
            known, parts = True, [head]
    body = b"".join(parts)
    return (body, window.start + at - len(unpack.unused_data)) if known and b"\r\n\r\n" in body else None


def parse(record: bytes) -> dict | None:
    """Headers and block of a record; None unless the length it states is there."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    length = fields.get("Content-Length", "")
    if not length.isdigit() or len(rest) < int(length) or "WARC-Type" not in fields:
        return None
    return {"fields": fields, "block": rest[: int(length)]}


def _page(name: str | None) -> str | None:
    value = (name or "").removeprefix(f"<{RECORD}").removesuffix(">")
    return unquote(value[1:]) if value.startswith("=") else None


def records_in(source: pa.NativeFile, start: int, end: int) -> Iterator[dict]:
    """Records whose member starts in [start, end)."""
    window = _Window(source, start)
    at = start
    while at < end:
        found = window.data.find(MAGIC, at - window.start)
        if found < 0:
            at = max(at, window.start + len(window.data) - len(MAGIC) + 1)
            window.drop(min(at, window.start + len(window.data)))
            if not window.more():
                return
            continue
        at = window.start + found
        if at >= end:
            return
        got = member_at(window, at)
        record = parse(got[0]) if got else None
        if record:
            yield record
            at = got[1]
        else:
            at += 1
        window.drop(min(at, window.start + len(window.data)))


def read_warc(spark: SparkSession, files: DataFrame, split_bytes: int = 32 << 20, max_tasks: int = 20_000) -> DataFrame:
    """Read files (path, bytes) in byte ranges of ``split_bytes``: a row per record.

    Returns page_id (as text), url, record_type, payload (null for revisits), payload_digest (bare, of
    the payload that was read, for revisits of their header) and refers_to. Files and ranges without
    records give no rows. Null paths are skipped.

    There are as many tasks as ranges, up to ``max_tasks``; a task then reads several ranges one after
    another. The number is given, since by the few bytes of the list itself Spark would take one task.
    """
    ranges = files.where("path is not null and bytes > 0").select("path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"))
    tasks = max(1, min(files.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 0, max_tasks))
    # By a hash, not round-robin, so that a task that runs again sends the same ranges.
    ranges = ranges.repartition(tasks, "path", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in READ.split(", ")]
        types = (pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

        rows, held = [], 0
        for batch in batches:
            for path, start, end in zip(*[c.to_pylist() for c in batch.columns]):
                fs, name = FileSystem.from_uri(path)
                with fs.open_input_file(name) as source:
                    for record in records_in(source, start, end):
                        f, block = record["fields"], record["block"]
                        full = f["WARC-Type"] == "response"
                        target = f.get("WARC-Target-Text")
                        url = f.get("WARC-Target-URI") if target is None else unquote(target)
                        digest = base32_sha1(block) if full else f.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                        rows.append((_page(f.get("WARC-Record-ID")), url, f["WARC-Type"], block if full else None, digest, None if full else _page(f.get("WARC-Refers-To"))))
                        held += len(block)
                        if held >= 4 * CHUNK or len(rows) >= 2000:
                            yield batch_of(rows)
                            rows, held = [], 0
        yield batch_of(rows)

    return ranges.mapInArrow(read, READ)


def resolved(records: DataFrame) -> DataFrame:
    """Records with payload_bytes: a revisit has the length of the payload that it refers to."""
    light = records.select("page_id", "url", "record_type", "payload_digest", "refers_to", F.octet_length("payload").cast("long").alias("own_bytes"))
    light = materialise(light, "warc-records")
    sent = light.where("record_type = 'response'").groupBy(F.col("page_id").alias("of_page"), F.col("payload_digest").alias("of_digest")).agg(F.max("own_bytes").alias("of_bytes"))
    full = light.where("record_type = 'response'").withColumn("payload_bytes", F.col("own_bytes"))
    visits = light.where("record_type <> 'response'").join(sent, F.col("refers_to").eqNullSafe(F.col("of_page")) & (F.col("payload_digest") == F.col("of_digest")), "left")
    visits = visits.withColumn("payload_bytes", F.col("of_bytes")).select(full.columns)
    return full.unionByName(visits).drop("own_bytes")
