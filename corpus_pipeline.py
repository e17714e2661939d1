"""A training corpus from raw documents: each stage reads what its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import shared_folder
from tickloom.llm.bpe import decode, encode
from tickloom.llm.common import materialise
from tickloom.llm.exact_dedup import drop_copies
from tickloom.llm.language import train, with_language
from tickloom.llm.minhash import drop_near_duplicates
from tickloom.llm.mixing import mixed_documents
from tickloom.llm.queries import RANKS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language of the labelled ones; those without letters or in none of them go.

    Learned from the documents whose language is given. If none is, every document goes. Null and
    empty texts go; repeated rows are decided alike; an empty table stays empty.
    """
    return with_language(docs, train(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that differ by white space at most, the row with the smallest doc_id stays.

    Null texts are equal to empty ones; of rows that repeat id and text one stays; null ids sort last.
    """
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays.

    Texts without words all stay; of equal smallest ids one row stays; null ids sort last.
    """
    return drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weights 1, 2, 3: a document appears as often as the mix takes it, at most 3 times.

    A null source is a source; texts without words are never taken; an empty table stays empty.
    """
    return mixed_documents(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they decode to: a row per row.

    A null text has no ids and decodes to an empty text. Ids are written before they are decoded, so
    that no task holds two Python workers.
    """
    encoded = materialise(encode(docs, RANKS, public_tokenizers.PATTERN, columns=["doc_id", "lang", "source"]), "pipeline-ids")
    found = decode(encoded, RANKS)
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode_bpe", encode_bpe),
]

#: A trained language model and a tokenizer can't be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
