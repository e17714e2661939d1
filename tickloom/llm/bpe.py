"""Byte-level BPE over a corpus: every distinct pre-token of the corpus is encoded once.

A pre-token pass cuts texts into blocks: the distinct pre-tokens of a block, and for each document
the positions of its pre-tokens among them. The distinct pre-tokens meet in a shuffle by their hash,
where each is encoded once; the ids go back to their blocks, and the positions put every document
together. Decoding joins ids with the table of token bytes.
"""

from __future__ import annotations

import base64
import itertools
import math
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import col, packed, with_results

#: A vocabulary is broadcast; larger files than this are refused.
MAX_VOCABULARY_BYTES = 64 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line per token, its bytes in base 64 and its rank."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def pack_numbers(values: np.ndarray) -> bytes:
    """Small unsigned numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack_numbers(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(n)


def pack_words(words: list[bytes]) -> tuple[bytes, int, bytes]:
    """Lengths, total length and bytes of words, compressed."""
    whole = b"".join(words)
    return pack_numbers(np.fromiter(map(len, words), np.uint32, len(words))), len(whole), pa.compress(whole, "zstd", asbytes=True)


def unpack_words(n: int, lengths: bytes, n_bytes: int, data: bytes) -> list[str]:
    whole = pa.decompress(data, n_bytes, "zstd", asbytes=True)
    ends = np.cumsum(unpack_numbers(lengths, n), dtype=np.int64).tolist()
    return [whole[a:b].decode() for a, b in zip([0, *ends], ends)]


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in small slices, so that few rows at a time become Python objects."""
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)
        pa.default_memory_pool().release_unused()


def numbering() -> dict[str, int]:
    """Words to numbers from 0: a word that is asked for the first time gets the next one."""
    return defaultdict(itertools.count().__next__)


def blocks_of(rows: DataFrame, pattern: str, block_bytes: int) -> Callable[[Callable, T.StructType], DataFrame]:
    """Cut rows (text, row) into blocks of ``block_bytes`` of text and give each to a function.

    Documents stay in the task that read them. The function sees the block's number, the checksum of
    its distinct pre-tokens, these in order of appearance, per document the positions of its
    pre-tokens among them (none of them if ``positions`` is false), and the rows.
    """

    def with_blocks(use: Callable, schema: T.StructType, positions: bool = True) -> DataFrame:
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split = regex.compile(pattern).findall
            number = TaskContext.get().partitionId() << 32
            index = numbering()
            docs: list[np.ndarray] = []
            kept: list[pa.Array] = []
            size = 0

            def flush() -> Iterator[pa.RecordBatch]:
                words = [w.encode() for w in index]
                check = zlib.crc32(b"\0".join(words))
                yield from use(number, check, words, docs, pa.concat_arrays(kept))

            for batch in pieces(batches):
                texts, row, first = batch.column(0).to_pylist(), batch.column(1), 0
                for i, text in enumerate(texts):
                    found = split(text)
                    if positions:
                        docs.append(np.fromiter(map(index.__getitem__, found), np.uint32, len(found)))
                    else:
                        index.update(dict.fromkeys(found))
                    size += len(text)
                    if size >= block_bytes:
                        kept.append(row.slice(first, i + 1 - first))
                        first = i + 1
                        yield from flush()
                        number, index, docs, kept, size = number + 1, numbering(), [], [], 0
                if first < len(texts):
                    kept.append(row.slice(first))
            if kept:
                yield from flush()

        return rows.select("text", "row").mapInArrow(cut, schema)

    return with_blocks


def bucket_of(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))


def document_rows(with_blocks: Callable, row_type: T.DataType, row_arrow: pa.DataType, buckets: int) -> DataFrame:
    """(block, check, ord, row, n, positions) per document; ord -1 has the bucket of each pre-token."""

    def use(number: int, check: int, words: list[bytes], docs: list[np.ndarray], row: pa.Array) -> Iterator[pa.RecordBatch]:
        names = ["block", "check", "ord", "row", "n", "positions"]
        types = (pa.int64(), pa.int64(), pa.int32(), None, pa.int32(), pa.binary())
        of = bucket_of(words, buckets)
        n = len(docs)
        for values in (
            ([number] * n, [check] * n, range(n), row, [len(d) for d in docs], [pack_numbers(d) for d in docs]),
            ([number], [check], [-1], pa.nulls(1, row_arrow), [len(of)], [pack_numbers(of)]),
        ):
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, types)], names)

    fields = [("block", T.LongType()), ("check", T.LongType()), ("ord", T.IntegerType()), ("row", row_type), ("n", T.IntegerType()), ("positions", T.BinaryType())]
    return with_blocks(use, T.StructType([T.StructField(*f) for f in fields]))


WORD_ROWS = "block long, check long, bucket int, n int, lengths binary, n_bytes long, data binary"


def word_rows(with_blocks: Callable, buckets: int) -> DataFrame:
    """A row per block and bucket with the block's pre-tokens in that bucket."""

    def use(number: int, check: int, words: list[bytes], docs: list[np.ndarray], row: pa.Array) -> Iterator[pa.RecordBatch]:
        of = bucket_of(words, buckets)
        order = np.argsort(of, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(of[order])) + 1) if len(words) else []:
            values = (number, check, int(of[some[0]]), len(some), *pack_words([words[i] for i in some]))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], [f.split()[0] for f in WORD_ROWS.split(", ")])

    return with_blocks(use, WORD_ROWS, positions=False)


def encode_words(words: DataFrame, ranks: object, pattern: str, buckets: int) -> DataFrame:
    """Ids of the pre-tokens of each block and bucket: each distinct pre-token of a bucket is encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, now, known = None, None, {}
        for batch in batches:
            for block, check, bucket, n, *packed_words in zip(*[c.to_pylist() for c in batch.columns]):
                if encoding is None:
                    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
                if bucket != now:
                    now, known = bucket, {}
                some = unpack_words(n, *packed_words)
                for w in some:
                    if w not in known:
                        known[w] = encoding.encode_ordinary(w)
                ids = [known[w] for w in some]
                lengths = np.fromiter(map(len, ids), np.uint32, n)
                flat = np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))
                values = (block, check, bucket, n, pack_numbers(lengths), len(flat), pack_numbers(flat))
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], ["block", "check", "bucket", "n", "lengths", "n_ids", "ids"])

    dealt = words.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(encode, "block long, check long, bucket int, n int, lengths binary, n_ids long, ids binary")


def put_together(docs: pa.Table, encoded: pa.Table) -> tuple[pa.Array, pa.Array]:
    """The documents of one block: their rows, and their ids as lists."""
    head = docs.filter(pc.equal(docs["ord"], -1))
    docs = docs.filter(pc.greater_equal(docs["ord"], 0))
    row = docs["row"].combine_chunks()
    if len(head) != 1 or len({*head["check"].to_pylist(), *docs["check"].to_pylist(), *encoded["check"].to_pylist()}) != 1:
        raise ValueError("the rows came in another order when they were read again; write them to a table first")
    of = unpack_numbers(head["positions"][0].as_py(), head["n"][0].as_py())
    encoded = encoded.sort_by("bucket").to_pylist()
    lengths = np.concatenate([unpack_numbers(e["lengths"], e["n"]) for e in encoded]).astype(np.int64) if encoded else np.zeros(0, np.int64)
    flat = np.concatenate([unpack_numbers(e["ids"], e["n_ids"]) for e in encoded]).astype(np.int32) if encoded else np.zeros(0, np.int32)
    # Word i of the block is the next of its bucket: where its ids begin and how many they are.
    order = np.argsort(of, kind="stable")
    starts, counts = np.empty(len(of), np.int64), np.empty(len(of), np.int64)
    starts[order], counts[order] = np.cumsum(lengths) - lengths, lengths
    sizes, parts = [], []
    for n, positions in zip(docs["n"].to_pylist(), docs["positions"].to_pylist()):
        at = unpack_numbers(positions, n)
        c = counts[at]
        total = int(c.sum())
        parts.append(flat[np.repeat(starts[at] - (np.cumsum(c) - c), c) + np.arange(total)])
        sizes.append(total)
    pa.default_memory_pool().release_unused()
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32), pa.int32()))
    return row, ids


def encode(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    text_col: str = "text",
    columns: list[str] | None = None,
    block_bytes: int = 4 << 20,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """Encode every text; returns ``columns`` (all by default) and ids, an array of integers.

    Each match of ``pattern`` is encoded separately by the ranks in ``rank_path`` (read on the driver
    and broadcast, at most MAX_VOCABULARY_BYTES); there are no special tokens.

    * A null or empty text has no ids. Ids, other nulls, ties and repeated rows play no part: a row
      gives a row, whatever it holds. An empty table gives an empty result. A result takes the place
      of an input column of its name.
    * A text longer than ``block_bytes`` is a block of its own.

    A pre-token in every text reaches its bucket once a block. A task holds a block, or the distinct
    pre-tokens of a bucket. The table is read twice and must give its rows in the same order, as files
    do; checksums of the blocks turn anything else into an error.
    """
    names = docs.columns if columns is None else columns
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(rank_path))
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    rows = docs.select(text.alias("text"), packed(docs, names).alias("row"))
    row_arrow = rows.select("row").limit(0).toArrow().schema.field("row").type
    with_blocks = blocks_of(rows, pattern, block_bytes)
    documents = document_rows(with_blocks, rows.schema["row"].dataType, row_arrow, buckets)
    encoded = encode_words(word_rows(with_blocks, buckets), ranks, pattern, buckets)
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def join(docs: pa.Table, encoded: pa.Table) -> pa.Table:
        return pa.table(dict(zip(("row", "ids"), put_together(docs, encoded))))

    whole = documents.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(join, schema)
    return with_results(whole, "row", names, {"ids": F.col("ids")})


def decode(encoded: DataFrame, rank_path: str, ids_col: str = "ids", slice_ids: int = 1 << 18, part_ids: int = 128) -> DataFrame:
    """Join ids with the table of token bytes: the rows with a column decoded, the bytes of the text.

    Null ids give null, no ids give no bytes; an id that the table lacks is an error. A column of the
    name decoded is replaced. The table of token bytes is broadcast. Spark fills Arrow batches by
    rows, so ids go to Python in parts of ``part_ids``: a batch is small however long the texts are.
    """
    spark = encoded.sparkSession
    table = spark.sparkContext.broadcast(read_ranks(rank_path))
    names = [c for c in encoded.columns if c.lower() != "decoded"]
    rows = encoded.select(col(ids_col).cast("array<int>").alias("ids"), packed(encoded, names).alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("decoded", T.BinaryType())])
    parts = F.greatest(F.ceil(F.coalesce(F.size("ids"), F.lit(0)) / part_ids).cast("int"), F.lit(1))
    cut = rows.select("ids", "row", parts.alias("parts")).withColumn("part", F.explode(F.sequence(F.lit(1), "parts")))
    last = F.col("part") == F.col("parts")
    cut = cut.select(F.slice("ids", (F.col("part") - 1) * part_ids + 1, F.lit(part_ids)).alias("ids"), last.alias("last"), F.when(last, F.col("row")).alias("row"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: pa.Array | None = None
        held: list[pa.Array] = []  # ids of a row whose other parts are in the next batch
        for batch in batches:
            if tokens is None:
                by_id = {i: token for token, i in table.value.items()}
                tokens = pa.array([by_id.get(i) for i in range(max(by_id, default=-1) + 1)], pa.binary())
            ids, ends, row = batch.column(0), np.flatnonzero(batch.column(1)), batch.column(2)
            stops = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(), dtype=np.int64)[ends] + sum(map(len, held))
            held.append(ids.flatten())
            if not len(ends):
                continue
            flat = pa.concat_arrays(held)
            row, missing = row.take(pa.array(ends)), ids.is_null().take(pa.array(ends))
            first, start = 0, 0
            for i, stop in enumerate(stops.tolist(), 1):
                if stop - start >= slice_ids or i == len(stops):
                    text = joined(flat.slice(start, stop - start), stops[first:i] - start, tokens)
                    text = pc.if_else(missing.slice(first, i - first), pa.scalar(None, pa.binary()), text)
                    yield pa.RecordBatch.from_arrays([row.slice(first, i - first), text], ["row", "decoded"])
                    first, start = i, stop
            held = [flat.slice(start)]
            pa.default_memory_pool().release_unused()

    def joined(ids: pa.Array, ends: np.ndarray, tokens: pa.Array) -> pa.Array:
        flat = tokens.take(ids)
        if flat.null_count:
            raise ValueError("an id is not in the table of token bytes")
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, flat), b"")

    done = cut.mapInArrow(look_up, schema)
    return with_results(done, "row", names, {"decoded": F.col("decoded")})
