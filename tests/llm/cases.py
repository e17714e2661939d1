"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet consectetur " * 4000
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for themselves.
        *[T.StructField(c, T.StringType()) for c in ("row", "uid", "kept", "size", "digest", "shard", "key", "bucket", "block", "ids", "finish.at")],
    ]
)
TEXTS = [
    (1, "one two three four five six"),
    (2, "one two  three\tfour five six"),
    (3, None),
    (4, ""),
    (5, "  "),
    (6, LONG),
    (7, LONG),
    (8, "1234 !!! 5678"),
    (9, "über straße naïve 日本語 \U0001f600 é"),
    (None, "a row without an id has words too"),
    (None, "one two three four five six"),
    (10, "the same row twice"),
    (10, "the same row twice"),
    (11, "an id with two texts"),
    (11, "an id with two other texts"),
]


def rows(texts=TEXTS):
    return [(i, t, None if n % 4 == 3 else "en", None if n % 5 == 4 else f"s{n % 3}", None, *["x"] * 11) for n, (i, t) in enumerate(texts)]


def odd(spark, texts=TEXTS):
    return spark.createDataFrame(rows(texts), SCHEMA).repartition(3, "text")


def none(spark):
    return spark.createDataFrame([], SCHEMA)
