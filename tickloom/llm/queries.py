"""One query per operator over its whole table, and the same results as SQL where SQL has them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import embeddings
from tickloom.llm.bpe import decode, encode
from tickloom.llm.common import materialise, table
from tickloom.llm.exact_dedup import exact_dedup
from tickloom.llm.language import identify, train
from tickloom.llm.minhash import near_duplicates
from tickloom.llm.mixing import mix
from tickloom.llm.negatives import hard_negatives
from tickloom.llm.neighbours import nearest
from tickloom.llm.passages import repeated_passages
from tickloom.llm.secrets import joined, scan_secrets
from tickloom.llm.sharding import shuffle_into_shards
from tickloom.llm.spelling import counted_words, deleted_at, spelling_variants
from tickloom.llm.warc import read_warc, resolved, write_warc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def in_fold(held_out: bool) -> Column:
    """Documents are held out of training where crc32 of the id as text, modulo 4, is 2."""
    two = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    return two if held_out else ~two


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs.where(in_fold(False))), columns=["doc_id"])
    return found.select("doc_id", in_fold(True).alias("held_out"), "lang_pred", "score")


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a similarity of 0.85 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), columns=["doc_id"], percent=85)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that another document repeats with a similarity of 0.8 or more."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors with a cosine of 0.95 or more."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), columns=["vec_id"])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page after a round trip through WARC files."""
    pages = table(spark, sf_dir, "pages")
    id_type = pages.schema["page_id"].dataType
    read = resolved(read_warc(spark, write_warc(pages)))
    return read.select(F.col("page_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document in random order."""
    return shuffle_into_shards(table(spark, sf_dir, "documents"), columns=["doc_id", "text"]).drop("text")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text: counts and digest of the base spans, and all spans."""
    found = scan_secrets(table(spark, sf_dir, "documents"), columns=["doc_id"])
    n = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[n(kind) for kind in ("assign", "access", "hex")],
        F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256"),
        joined(F.concat("base_spans", "entropy_spans")).alias("spans"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document."""
    return exact_dedup(table(spark, sf_dir, "documents"), columns=["doc_id"])


def bpe_digests(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Ids of every text and the text they decode to, as digests."""
    found = decode(encode(docs, RANKS, public_tokenizers.PATTERN, columns=columns), RANKS)
    return found.select(
        *columns,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document, and back."""
    return bpe_digests(table(spark, sf_dir, "documents"), ["doc_id"])


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when sources are mixed by weights 1, 2, 3."""
    return mix(table(spark, sf_dir, "documents"), columns=["doc_id"])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score nearly as high as the positives of every hundredth vector."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def misspelt_runs(docs: DataFrame) -> DataFrame:
    """A row (word) per run of letters, A-Z in lower case; by a hash of document and run, some lack a code point."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit("([A-Za-z\u00C0-\u00FF]+)"), F.lit(1))).alias("run"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    runs = runs.withColumn("h", F.crc32(name.cast("binary")))
    place = (F.col("h") % F.length("run")).cast("int")
    return runs.select(F.when(F.col("h") % 97 == 0, deleted_at(F.col("run"), place)).otherwise(F.col("run")).alias("word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usual form and the root of every word of the documents that occurs three times or more."""
    return spelling_variants(materialise(counted_words(misspelt_runs(table(spark, sf_dir, "documents"))), "spelling-counts"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    found = nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_warc": op5_warc,
    "op6_shard": op6_shard,
    "op7_secret_scan": op7_secret_scan,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_bpe": op9_bpe,
    "op10_mix_sources": op10_mix_sources,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_nearest": op13_nearest,
}
