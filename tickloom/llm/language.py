"""Language identification in two steps: first the family, then the language within it.

At both steps linear support vector machines decide between every two candidates, and the candidate
that wins most comparisons is taken. Features are counts of one to four bytes of the lower-case
letters, hashed, damped by a square root and scaled to length one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import col, materialise, packed, with_results

UNKNOWN = "und"
FEATURES = 1 << 12
GRAMS = (1, 2, 3, 4)
CHUNK_BYTES, CHUNK_DOCS = 1 << 20, 256
MAX_LANGUAGES = 300

#: Families of languages, by ISO 639-1 code. A language that is missing is in "other".
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ca co es fr gl it la oc pt ro sc wa",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv kw",
    "hellenic": "el",
    "albanian": "sq",
    "armenian": "hy",
    "indo_aryan": "as bn gu hi mr ne or pa sa sd si ur",
    "iranian": "fa ku ps tg",
    "uralic": "et fi hu se",
    "turkic": "az ba kk ky tk tr tt ug uz",
    "semitic": "am ar he mt ti",
    "sinitic": "zh",
    "japonic": "ja",
    "koreanic": "ko",
    "dravidian": "kn ml ta te",
    "austronesian": "fj haw id jv mg mi ms sm su tl to",
    "austroasiatic": "km vi",
    "tai": "lo th",
    "bantu": "ln rn rw sn st sw tn ts xh zu",
    "basque": "eu",
    "kartvelian": "ka",
    "mongolic": "mn",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], "other")


def letters(text: Column) -> Column:
    """Lower-case letters with a space for everything between them; null as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\P{L}+", " "))


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, last, rows of features) for chunks of texts; the whole of every text counts."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        last = min(last, first + CHUNK_DOCS, len(texts))
        counts = np.zeros((last - first) * FEATURES, np.int64)
        lo, end = int(offsets[first]), int(offsets[last])
        ends = offsets[first + 1 : last + 1]
        while lo < end:  # a text longer than a chunk is counted in pieces that overlap by a gram
            hi = min(end, lo + 2 * CHUNK_BYTES)
            piece = data[lo : min(end, hi + max(GRAMS) - 1)].astype(np.uint32)
            at = np.arange(lo, hi)
            doc = np.searchsorted(ends, at, "right")
            room = ends[doc] - at
            key = np.zeros(hi - lo, np.uint32)
            for n in GRAMS:
                some = np.flatnonzero(room >= n)
                key = key * np.uint32(257) + np.pad(piece, (0, n))[n - 1 : n - 1 + hi - lo] + np.uint32(1)
                h = (key[some] * np.uint32(2654435761)) ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
                h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
                counts += np.bincount(doc[some] * FEATURES + (h >> np.uint32(20)), minlength=len(counts))
            lo = hi
        x = np.sqrt(counts.reshape(-1, FEATURES)).astype(np.float32)
        yield first, last, x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        first = last


def support_vector_machine(x: np.ndarray, y: np.ndarray, cost: float = 1000.0, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Linear machine for labels +1 and -1: squared hinge loss, accelerated gradient steps, classes weighted equally."""
    x = np.hstack([x.astype(np.float64), np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * cost
    step = 1.0 / (1.0 + 4.0 * weight.sum())  # rows have a squared length of at most two
    w = v = np.zeros(x.shape[1])
    for i in range(rounds):
        slack = np.maximum(0.0, 1.0 - y * (x @ v))
        new = v - step * (v - 2.0 * x.T @ (weight * y * slack))
        v = new + i / (i + 3.0) * (new - w)
        w = new
    return w[:-1].astype(np.float32), float(w[-1])


@dataclass(frozen=True)
class Model:
    """Machines as (level, a, b): positive for a. Level is empty between families, else the family."""

    languages: tuple[str, ...]
    machines: tuple[tuple[str, str, str], ...]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = x @ self.weights + self.bias if self.machines else np.zeros((len(x), 0))
        families = sorted({family_of(lang) for lang in self.languages})
        family, sure = self._vote("", families, margins)
        names, score = [""] * len(x), np.zeros(len(x))
        for i, f in enumerate(families):
            rows = np.flatnonzero(family == i)
            langs = [lang for lang in self.languages if family_of(lang) == f]
            best, s = self._vote(f, langs, margins[rows])
            score[rows] = np.minimum(sure[rows], s)
            for row, b in zip(rows, best):
                names[row] = langs[b]
        return names, score

    def _vote(self, level: str, names: list[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winner of most comparisons, ties by the sum of probabilities, and its lowest probability."""
        n = len(names)
        p = np.full((len(margins), n, n), np.nan)
        for k, (at, a, b) in enumerate(self.machines):
            if at == level:
                chance = 1.0 / (1.0 + np.exp(-np.clip(2.0 * margins[:, k], -50, 50)))
                i, j = names.index(a), names.index(b)
                p[:, i, j], p[:, j, i] = chance, 1.0 - chance
        votes = np.nansum(p > 0.5, axis=2) + np.nansum(p, axis=2) / (n + 1.0)
        best = votes.argmax(axis=1)
        lowest = np.nanmin(p[np.arange(len(p)), best], axis=1) if n > 1 and len(p) else np.ones(len(p))
        return best, lowest


def training_sample(labelled: DataFrame, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """At most ``per_language`` different texts of each language, those of the smallest hashes.

    Hashes alone are ranked first; the texts are read again below the threshold of their language.
    """
    rows = labelled.select(letters(col(text_col)).alias("letters"), col(lang_col).cast("string").alias("lang")).where("lang is not null and letters <> ''")
    rows = rows.withColumn("hash", F.xxhash64("letters", F.lit(29)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    chosen = rows.select("lang", "hash").distinct().withColumn("rank", rank).where(F.col("rank") <= per_language)
    limits = chosen.groupBy("lang").agg(F.max("hash").alias("limit")).limit(MAX_LANGUAGES + 1).collect()
    if len(limits) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    limits = labelled.sparkSession.createDataFrame([tuple(r) for r in limits], "of_lang string, limit long")
    below = rows.join(F.broadcast(limits), (F.col("lang") == F.col("of_lang")) & (F.col("hash") <= F.col("limit")))
    return below.groupBy("lang", "hash").agg(F.min("letters").alias("letters")).withColumn("rank", rank)


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 500) -> Model:
    """Learn from rows with a language; rows whose text or language is null or without letters are left out.

    The sample is bounded: ``per_language`` texts of each of at most MAX_LANGUAGES languages. Each
    machine is a group of at most twice that many rows; the driver gets one weight vector a machine.
    """
    rows = materialise(training_sample(labelled, text_col, lang_col, per_language), "language-sample")
    languages = tuple(sorted(r["lang"] for r in rows.select("lang").distinct().collect()))
    families = sorted({family_of(lang) for lang in languages})
    pairs: list[tuple[str, str, str]] = [("", a, b) for a, b in combinations(families, 2)]
    for f in families:
        pairs += [(f, a, b) for a, b in combinations([lang for lang in languages if family_of(lang) == f], 2)]
    if not pairs:
        return Model(languages, (), np.zeros((FEATURES, 0), np.float32), np.zeros(0, np.float32))
    uses: list[tuple[str, int, int, int]] = []
    for k, (level, a, b) in enumerate(pairs):
        for side, name in ((1, a), (-1, b)):
            members = [name] if level else [lang for lang in languages if family_of(lang) == name]
            uses += [(lang, k, side, -(-per_language // len(members))) for lang in members]
    uses = labelled.sparkSession.createDataFrame(uses, "lang string, machine int, side int, most int")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, x in features(batch["letters"]):
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part["lang"], part["hash"], part["rank"], pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "hash", "rank", "x"])

    known = rows.mapInArrow(featurise, "lang string, hash long, rank int, x binary")
    known = known.join(F.broadcast(uses), "lang").where("rank <= most").select("machine", "side", "lang", "hash", "x")

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["side", "lang", "hash"])
        x = np.frombuffer(b"".join(group["x"]), np.float32).reshape(len(group), FEATURES)
        w, b = support_vector_machine(x, group["side"].to_numpy(np.float64))
        return pd.DataFrame({"machine": [group["machine"].iloc[0]], "w": [w.tobytes()], "b": [b]})

    learned = known.groupBy("machine").applyInPandas(learn, "machine int, w binary, b double").orderBy("machine").collect()
    weights = np.stack([np.frombuffer(bytes(r["w"]), np.float32) for r in learned], axis=1)
    return Model(languages, tuple(pairs), weights, np.array([r["b"] for r in learned], np.float32))


def identify(docs: DataFrame, model: Model, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """Predict the language of every whole text from the text alone.

    Returns ``columns`` (all by default), then lang_pred and score, the lowest chance of the winner
    in its comparisons.

    * A text that is null, empty or without letters is ``und`` with score 0; so is every text if the
      model has learned no language. A model of one language predicts it with score 1.
    * A row gives a row, whatever repeats; an empty table gives an empty result. A result takes the
      place of an input column of its name.
    """
    names = docs.columns if columns is None else columns
    rows = docs.select(letters(col(text_col)).alias("letters"), packed(docs, names).alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blank = pc.equal(batch["letters"], "").to_numpy(zero_copy_only=False)
            for first, last, x in features(batch["letters"]):
                none = blank[first:last] if model.languages else np.ones(last - first, bool)
                langs, score = model.predict(x) if model.languages else ([UNKNOWN] * len(x), np.zeros(len(x)))
                langs = [UNKNOWN if n else lang for n, lang in zip(none, langs)]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part["row"], pa.array(langs, pa.string()), pa.array(np.where(none, 0.0, score), pa.float64())], ["row", "lang_pred", "score"])

    done = rows.mapInArrow(predict, schema)
    return with_results(done, "row", names, {"lang_pred": F.col("lang_pred"), "score": F.col("score")})


def with_language(docs: DataFrame, model: Model, text_col: str = "text", least_score: float = 0.5) -> DataFrame:
    """The rows in a language that the model knows, with exactly the columns of ``docs``.

    A row goes if its text has no letters, or if its winner lost a comparison (score below
    ``least_score``), so that no language fits it.
    """
    inner = docs.select(packed(docs).alias("row"), col(text_col).alias("_text"))
    found = identify(inner, model, "_text", ["row"]).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
