"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch: in round i every shingle is hashed to one of t places with a value in [i, i + 1), and each
place keeps its smallest value; rounds end when all places are full. From round t on all shingles go
to place i - t, so 2 t rounds fill every place of any set that isn't empty. Equal places estimate
the Jaccard similarity with the concentration of independent draws.

Candidates share a band of the sketch. A first round gives each bucket a hub and verifies its members
against it, which joins groups of near copies without any pair inside them. Buckets whose members are
then still in several components are joined to families; a family is dealt into blocks of bounded
size, and a block compares and verifies its members inside one task: a pair that sizes, sketches or links
found before don't rule out is decided there on full sets. Out of a block come only links that join
something, fewer than it has members, however many of its pairs are alike.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import col, components, materialise, packed, placed, unpacked, with_results

WIDTH = 5
BANDS, ROWS = 24, 5
PLACES = BANDS * ROWS
HUB_ROUNDS = 1
BLOCK, BLOCK_SHINGLES = 512, 500_000
ROWS_A_TASK, MOST_TASKS = 1024, 20_000
SLICE = 256
CHUNK_BYTES = 512 << 10
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def normal(text: str | None) -> bytes:
    """A-Z in lower case, words joined by single spaces; null as empty. Splits at bytes 9 to 13 and 32."""
    return b" ".join((text or "").encode().translate(LOWER).split())


def class_key(words: bytes) -> bytes:
    """Copies have one key: 16 bytes of SHA-256."""
    return hashlib.sha256(words).digest()[:16]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches in slices, so that few texts are Python objects at a time; memory that Arrow no longer uses is given back."""
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)
        pa.default_memory_pool().release_unused()


def normalised(rows: DataFrame) -> DataFrame:
    """Rows (text, ...) to (key, words, ...)."""
    rest = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            words = [normal(t) for t in batch["text"].to_pylist()]
            keys = pa.array([class_key(w) for w in words], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, pa.array(words, pa.binary()).cast(pa.string()), *[batch[c] for c in rest]], ["key", "words", *rest])

    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("words", T.StringType()), *[rows.schema[c] for c in rest]])
    return rows.mapInArrow(run, schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for spans in order, from differences of one prefix hash per chunk."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK_BYTES, "right")))
        lo, hi = int(starts[first]), int(ends[last - 1])
        terms = (data[lo:hi].astype(np.uint64) + np.uint64(1)) * powers(BASE, hi - lo)
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        s, e = starts[first:last] - lo, ends[first:last] - lo
        out[first:last] = mixed((prefix[e] - prefix[s]) * powers(INVERSE, hi - lo)[s] + (e - s).astype(np.uint64))
        first = last
    return out


def shingle_spans(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of normal texts: their bytes, and the document, start and end of every shingle."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    full = np.flatnonzero(np.diff(offsets))
    spaces = np.flatnonzero(data == 32)
    starts = np.sort(np.concatenate([spaces + 1, offsets[full]]))
    ends = np.sort(np.concatenate([spaces, offsets[full + 1]]))
    doc = np.searchsorted(offsets, starts, "right") - 1
    n_words = np.bincount(doc, minlength=len(texts))
    # Word i begins a shingle if width words of its document follow, or it is the first of a short one.
    place = np.arange(len(starts)) - np.repeat((np.cumsum(n_words) - n_words), n_words)
    left = np.repeat(n_words, n_words) - place
    begins = np.flatnonzero((left >= width) | (place == 0))
    last = np.minimum(begins + width - 1, begins + left[begins] - 1)
    return data, doc[begins], starts[begins], ends[last]


def distinct_shingles(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every distinct shingle, by document."""
    data, doc, starts, ends = shingle_spans(texts, width)
    if not len(doc):
        return doc, np.zeros(0, np.uint64)
    hashes = span_hashes(data, starts, ends)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])])
    return doc[new], hashes[new]


def sketches(doc: np.ndarray, hashes: np.ndarray, n_docs: int, places: int = PLACES) -> np.ndarray:
    """A row of ``places`` numbers per document; documents without shingles have arbitrary rows."""
    out = np.full(n_docs * places, np.iinfo(np.uint64).max, np.uint64)
    for i in range(2 * places):
        if not len(doc):
            break
        h = mixed(hashes + np.uint64((i + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1))
        place = ((h >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64) if i < places else i - places
        np.minimum.at(out, doc * places + place, np.uint64(i << 56) | (h & np.uint64((1 << 56) - 1)))
        open_ = (out.reshape(n_docs, places) == np.iinfo(np.uint64).max).any(axis=1)
        more = open_[doc]
        doc, hashes = doc[more], hashes[more]
    return out.reshape(n_docs, places)


def band_keys(sketch: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = sketch.reshape(len(sketch), bands, -1)
    key = mixed(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(BASE))[None, :]
    for i in range(rows.shape[2]):
        key = mixed((key ^ rows[:, :, i]) + np.uint64(i + 1))
    return key.view(np.int64)


def sketched(rows: DataFrame) -> DataFrame:
    """Rows (text, id, row) to (key, id, row, n, bands, sketch)."""
    schema = rows.selectExpr("unhex('') key", "id", "row", "0L n", "array(0L) bands", "unhex('') sketch").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            words = [normal(t) for t in batch["text"].to_pylist()]
            sizes = np.cumsum([len(w) for w in words])
            first = 0
            while first < len(batch):
                so_far = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, so_far + CHUNK_BYTES, "right")))
                some, part = words[first:last], batch.slice(first, last - first)
                doc, hashes = distinct_shingles(pa.array(some, pa.large_binary()).cast(pa.large_string()))
                n = np.bincount(doc, minlength=len(part))
                sketch = sketches(doc, hashes, len(part))
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32))
                bands = pa.ListArray.from_arrays(offsets, pa.array(band_keys(sketch)[n > 0].ravel()))
                short = (mixed(sketch) & np.uint64(0xFFFF)).astype("<u2")
                keys = pa.array([class_key(w) for w in some], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [keys, part["id"], part["row"], pa.array(n, pa.int64()), bands, pa.array([r.tobytes() for r in short], pa.binary())],
                    ["key", "id", "row", "n", "bands", "sketch"],
                )
                first = last

    return rows.select("text", "id", "row").mapInArrow(run, schema)


def least_equal(percent: int) -> int:
    """A link of this similarity has fewer equal places with a chance below 1e-5."""
    p = percent / 100.0
    return math.floor(PLACES * p - 4.5 * math.sqrt(PLACES * p * (1.0 - p)))


def alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and sketches don't rule out."""
    side = lambda x: classes.select(F.col("key").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    least = least_equal(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u2").reshape(len(batch), PLACES) for c in ("sketch_a", "sketch_b"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return both.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a binary, b binary")


def in_components(bands: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (key, band, component) of the buckets that hold several components."""
    own = bands.join(groups.select(F.col("node").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    several = own.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m")).where("lo <> hi")
    return own.join(several.select("band", "m"), "band")


def with_hubs(members: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each member and the hub of its bucket; another member is the hub in each round."""
    order = F.struct(F.xxhash64("key", F.lit(turn)).alias("at"), "key", "component")
    hubs = members.groupBy("band").agg(F.min(order).alias("hub"))
    both = members.join(hubs, "band").where(F.col("component") != F.col("hub.component"))
    return both.select(F.col("key").alias("a"), F.col("hub.key").alias("b")).distinct()


def families(members: DataFrame) -> DataFrame:
    """Rows (key, family): members whose buckets are joined by common members."""
    hubs = members.groupBy("band").agg(F.min("key").alias("hub"))
    edges = members.join(hubs, "band").select(F.col("key").alias("a"), F.col("hub").alias("b")).where("a <> b").distinct()
    return components(edges).select(F.col("node").alias("key"), F.col("component").alias("family"))


def joined_inside(members: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components of the same family: enough of them to connect whatever pairs would.

    A family is dealt into parts of about BLOCK members and BLOCK_SHINGLES shingles, and every two parts
    meet in a block; a family of one part is one block, so most texts travel once.
    """
    own = materialise(families(members), "minhash-families")
    about = own.join(members.select("key", "component").distinct(), "key").join(classes.select("key", "n", "sketch"), "key")
    sizes = own.join(classes.select("key", "n"), "key").groupBy("family").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    parts = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("s") / BLOCK_SHINGLES)).cast("int")
    sizes = materialise(sizes.select("family", "m", parts.alias("parts")), "minhash-family-sizes")
    rows = sizes.agg(F.sum(F.col("m") * F.col("parts"))).first()[0] or 0
    tasks = int(min(MOST_TASKS, max(1, rows // ROWS_A_TASK)))
    dealt = about.join(sizes, "family").withColumn("part", F.pmod(F.xxhash64("key", F.lit(7)), "parts").cast("int"))
    dealt = dealt.join(texts, "key").withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    dealt = dealt.select("family", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "part", "key", "component", "n", "sketch", "words")
    least = least_equal(percent)

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys, part = table["key"].to_pylist(), table["part"].to_numpy()
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), "<u2").reshape(len(keys), PLACES)
        n = table["n"].to_numpy()
        ends = np.concatenate([[0], np.cumsum(n)])
        hashes = distinct_shingles(table["words"].combine_chunks())[1]
        names: dict[bytes, int] = {}
        top = [names.setdefault(c, len(names)) for c in table["component"].to_pylist()]
        of = np.array(top)
        found = []
        for i in np.flatnonzero(part == x):
            at = np.flatnonzero((part == y) & (np.arange(len(part)) > i if x == y else True))
            at = at[(np.minimum(n[i], n[at]) * 100 >= np.maximum(n[i], n[at]) * percent) & (of[at] != of[i])]
            equal = (sketch[i] == sketch[at]).sum(axis=1)
            at = at[equal >= least][np.argsort(-equal[equal >= least], kind="stable")]
            mine = hashes[ends[i] : ends[i + 1]]
            for begin in range(0, len(at), SLICE):
                some = at[begin : begin + SLICE]
                some = some[of[some] != of[i]]
                if not len(some):
                    continue
                theirs = np.concatenate([hashes[ends[j] : ends[j + 1]] for j in some])
                hits = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
                both = np.add.reduceat(hits, np.concatenate([[0], np.cumsum(n[some])[:-1]]), dtype=np.int64)
                for j in some[100 * both >= percent * (n[i] + n[some] - both)].tolist():
                    if of[j] != of[i]:
                        of[of == of[j]] = of[i]
                        found.append((keys[i], keys[j]))
        pa.default_memory_pool().release_unused()
        return pa.table({"a": pa.array([max(p) for p in found], pa.binary()), "b": pa.array([min(p) for p in found], pa.binary())})

    groups = ["family", "x", "y"]
    return dealt.repartition(tasks, *groups).groupBy(*groups).applyInArrow(compare, "a binary, b binary")


def _pairs(found: set) -> pa.RecordBatch:
    pairs = list(found)
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["a", "b"])


def shingle_set(words: str, width: int = WIDTH) -> set[str]:
    w = words.split(" ") if words else []
    return {" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def verified(pairs: DataFrame, texts: DataFrame, percent: int, group: int = 64) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``texts`` has (key, words).

    Members meet their common b in groups of about ``group``, so b travels once a group and no hub
    gathers all its members in one task.
    """
    counts = pairs.groupBy("b").agg(F.ceil(F.count("*") / group).cast("int").alias("groups"), F.count("*").alias("m"))
    counts = materialise(counts, "minhash-hubs")
    tasks = int(min(MOST_TASKS, max(1, (counts.agg(F.sum("m")).first()[0] or 0) // ROWS_A_TASK)))
    asked = pairs.join(counts, "b").select("b", F.pmod(F.xxhash64("a", F.lit(3)), "groups").cast("int").alias("g"), "a")
    members = asked.select("b", "g", F.col("a").alias("key"), F.lit(1).alias("turn"))
    members = members.unionByName(asked.select("b", "g").distinct().select("b", "g", F.col("b").alias("key"), F.lit(0).alias("turn")))
    joined = members.join(texts, "key").select("b", "g", "turn", "key", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, of = np.zeros(0, np.uint64), None
        for batch in sliced(batches):
            found = set()
            doc, hashes = distinct_shingles(batch["words"])
            ends = np.searchsorted(doc, np.arange(len(batch) + 1))
            for i, (b, g, turn, key) in enumerate(zip(*[batch[c].to_pylist() for c in ("b", "g", "turn", "key")])):
                mine = hashes[ends[i] : ends[i + 1]]
                if turn == 0:
                    hub, of = mine.copy(), (b, g)
                    continue
                if of != (b, g):
                    raise ValueError("a group lacks its hub")
                both = int((hub[np.minimum(np.searchsorted(hub, mine), len(hub) - 1)] == mine).sum())
                if 100 * both >= percent * (len(hub) + len(mine) - both):
                    found.add((key, b))
            yield _pairs(found)

    return joined.repartition(tasks, "b", "g").sortWithinPartitions("b", "g", "turn").mapInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    columns: list[str] | None = None,
    percent: int = 80,
) -> DataFrame:
    """Components of documents whose sets of five-word shingles have 100 * both >= percent * either.

    Words are what white space separates, with A-Z in lower case. A document of fewer than five words
    has its whole sequence as only shingle. Returns a row per input row: ``columns`` (all by
    default), then n_shingles, component_id (smallest id reachable, itself included) and kept (true
    for one row of each component, that of the smallest id).

    * Texts that are null or have no words have no shingles and no links: each stays.
    * A null id sorts after all others; component_id is null where no row of the component has an id.
    * Of rows that repeat the smallest id, one stays. Ids with several texts are several documents.
    * An empty table gives an empty result. A result takes the place of an input column of its name.

    ``percent`` of at least 80 is what bands and sketches are set for: a pair at 80 misses every band
    with a chance of 7e-5, one at 85 of 3e-6. Copies are one class from the start. Every band of a
    class is one row, whatever the size of its bucket.
    """
    if not 80 <= percent <= 100:
        raise ValueError("percent is 80 to 100")
    names = docs.columns if columns is None else columns
    rows = docs.select(col(text_col).cast("string").alias("text"), col(id_col).alias("id"), packed(docs, names).alias("row"))
    known = materialise(sketched(rows).withColumn("uid", F.monotonically_increasing_id()), "minhash-sketches")
    classes = known.where("n > 0").groupBy("key").agg(
        F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.min(F.struct(F.col("id").isNull().alias("missing"), "id")).alias("rep")
    )
    classes = materialise(classes.select("key", "n", "bands", "sketch", F.col("rep.id").alias("rep")), "minhash-classes")
    bands = classes.select("key", F.explode("bands").alias("band"))
    several = bands.groupBy("band").agg(F.count("*").alias("m")).where("m > 1").select("band")
    shared = materialise(bands.join(several, "band"), "minhash-shared")
    # The texts of all that have a candidate, once each.
    needed = shared.select("key").distinct().join(classes.select("key", "rep"), "key").select(F.col("key").alias("of_key"), "rep")
    texts = normalised(rows.select("text", "id")).join(needed, (F.col("key") == F.col("of_key")) & F.col("id").eqNullSafe(F.col("rep")))
    texts = materialise(texts.groupBy("key").agg(F.first("words").alias("words")), "minhash-texts")

    links = tested = classes.selectExpr("key a", "key b").limit(0)
    groups = classes.selectExpr("key node", "key component").limit(0)
    for turn in range(HUB_ROUNDS + 1):
        members = materialise(in_components(shared, groups), "minhash-members")
        if turn < HUB_ROUNDS:
            pairs = alike(with_hubs(members, turn), classes, percent)
            pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
            pairs = materialise(pairs.join(tested, ["a", "b"], "left_anti") if turn else pairs, "minhash-candidates")
            if pairs.isEmpty():
                continue
            tested = tested.unionByName(pairs) if turn else pairs
            found = materialise(verified(pairs, texts, percent), "minhash-links")
        else:
            found = materialise(joined_inside(members, classes, texts, percent), "minhash-links")
        if found.isEmpty():
            continue
        # Links only between components found so far: as few as still join them.
        ends = found
        if turn:
            name = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
            ends = found.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
        links = groups.selectExpr("node a", "component b").where("a <> b").unionByName(ends) if turn else ends
        groups = materialise(components(links), "minhash-groups")
    labels = known.join(groups.select(F.col("node").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    labels = labels.select("uid", "id", "row", "n", "component")
    reps = labels.where("n > 0").groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "uid")).alias("rep"))
    done = labels.where("n > 0").join(reps, "component").select("row", "n", F.col("rep.id").alias("component_id"), (F.col("uid") == F.col("rep.uid")).alias("kept"))
    alone = labels.where("n = 0").select("row", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return with_results(done.unionByName(alone), "row", names, {"n_shingles": F.col("n"), "component_id": F.col("component_id"), "kept": F.col("kept")})


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One document of each component, with exactly the columns of ``docs``."""
    rows = placed(docs, "minhash-documents")
    light = rows.select("uid", F.col("row").getField(id_col).alias("_id"), F.col("row").getField(text_col).alias("_text"))
    kept = near_duplicates(light, "_id", "_text", ["uid"], percent).where("kept").select("uid")
    return rows.join(kept, "uid", "left_semi").select(*unpacked(rows, "row", docs.columns))
