"""CSV feeds: incremental, typed and untyped reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

# Columns of lines that are set aside: the file, the text of the line, and why.
MISFITS = "source_file string, line string, reason string"

MAX_AGE = "36500d"
MAX_FILES = 1000


def stream_feed(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
    max_age: str = MAX_AGE,
    archive: str | None = None,
) -> DataFrame:
    """New CSV files below ``folder``, at any depth, as a stream.

    Columns are taken by position, so files must follow the schema's order. ``bounded`` tells what
    the other options do. ``archive`` moves files there once they are done, so that the driver,
    which remembers every name within ``max_age``, need not list and remember them for ever.
    """
    reader = spark.readStream.schema(schema).option("header", True).option("recursiveFileLookup", True)
    reader = bounded(reader, max_files, max_bytes, max_age)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(folder)


def stream_lines(
    spark: SparkSession,
    folder: str,
    max_files: int | None = None,
    max_bytes: str | None = None,
    max_age: str = MAX_AGE,
    archive: str | None = None,
) -> DataFrame:
    """Lines of new files below ``folder`` as a stream, headers included, each with the file it is of."""
    reader = bounded(spark.readStream.option("recursiveFileLookup", True), max_files, max_bytes, max_age)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.text(folder).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"))


def _is_header(schema: StructType) -> Column:
    plain = F.regexp_replace(F.lower("line"), r"[\s\"\x{FEFF}]", "")
    return plain == ",".join(schema.names).lower()


def fitted(lines: DataFrame, schema: StructType) -> tuple[DataFrame, bool]:
    """Lines of CSV files as rows (source_file, line, row, reason), and whether all of them fit.

    * A file must have a line with the names of the schema in their order (case, blanks and quotes
      don't count). All lines of a file without one have the reason ``header``: its columns may be
      swapped, and by position they would be taken for each other.
    * A line with a value that its type can't hold, or with fewer or more values, has the reason ``row``.
    * Rows that fit have no reason. Header lines and blank lines are no rows.

    A first pass counts both per file, combined before the shuffle. The driver gets the names of files
    with misfits, at most the files of a micro-batch, which the stream's source has listed there anyway.
    """
    unparsed = "_unparsed"
    checked = StructType([*schema.fields, StructField(unparsed, StringType())])
    parsed = lines.filter(F.trim("line") != "").withColumn(
        "row", F.from_csv("line", checked.toDDL(), {"columnNameOfCorruptRecord": unparsed})
    )
    header, bad = _is_header(schema), F.col(f"row.{unparsed}").isNotNull()
    files = parsed.groupBy("source_file").agg(F.bool_or(header).alias("headed"), F.bool_or(bad & ~header).alias("bad"))
    misfits = files.filter("bad OR NOT headed").collect()
    without = [f["source_file"] for f in misfits if not f["headed"]]
    wrong_file = F.col("source_file").isin(without) if without else F.lit(False)
    rows = parsed.filter(~header).withColumn("reason", F.when(wrong_file, "header").when(bad, "row"))
    return rows, not misfits


def bounded(
    reader: DataStreamReader, max_files: int | None = None, max_bytes: str | None = None, max_age: str = MAX_AGE
) -> DataStreamReader:
    """Bound a micro-batch, and take files however late they come.

    A batch is ``max_bytes`` if given, else ``max_files``, by default MAX_FILES: also a first run
    over a whole table then goes in steps. ``max_age`` is how far behind the newest file an unseen
    file may be; Spark's own default of a week would drop later ones without a word.
    """
    reader = reader.option("maxFileAge", max_age)
    if max_bytes:
        return reader.option("maxBytesPerTrigger", max_bytes)
    return reader.option("maxFilesPerTrigger", max_files or MAX_FILES)


def read_feed(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All files of a feed as one table."""
    return (
        spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(folder)
    )


def read_untyped(spark: SparkSession, folder: str) -> DataFrame:
    """A headed CSV folder with every column as text, for a first look."""
    return spark.read.option("header", True).option("recursiveFileLookup", True).csv(folder)
