"""File sinks: landed CSV snapshots, table appends and replay-safe batch writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.schemas import BATCH_TAG

# Micro-second ISO times; the CSV writer's own default cuts them to milliseconds.
_CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_ADAPTIVE = "spark.sql.adaptive.enabled"
# Beside a table: one marker for each complete batch.
COMMITS = "_commits"


def max_partition(df: DataFrame, columns: Sequence[str] = ("year", "month")) -> DataFrame:
    """One row with the largest value of each partition column."""
    return df.agg(*[F.max(c).alias(c) for c in columns])


def land_snapshot(df: DataFrame, feed_folder: str) -> str:
    """Append one snapshot as headed CSV below ``<feed>/<year>/<month>`` and return that folder."""
    newest = max_partition(df).first()
    folder = f"{feed_folder}/{newest['year']}/{newest['month']}"
    df.write.mode("append").option("header", True).option("timestampFormat", _CSV_TIME).csv(folder)
    return folder


def land_history(df: DataFrame, feed_folder: str) -> None:
    """Append a back-fill that spans months; year and month stay columns of the files too."""
    foldered = df.withColumns({"feed_year": F.col("year"), "feed_month": F.col("month")})
    (
        foldered.hint("rebalance", "feed_year", "feed_month")
        .write.mode("append")
        .partitionBy("feed_year", "feed_month")
        .option("header", True)
        .option("timestampFormat", _CSV_TIME)
        .csv(feed_folder)
    )


def append_table(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Append rows; small partitions get one file and large ones are split."""
    spread = df.hint("rebalance", *partition_by)
    spread.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_batch(df: DataFrame, path: str, partition_by: Sequence[str], batch_tag: str) -> None:
    """Write one micro-batch exactly once.

    The tag is the innermost partition. Partition columns stay in front, so readers still prune
    on them and need not know about the tag. A marker beside the table, written last, says that a
    tag is complete: a replay then leaves its files as they are, so that streams over the table
    don't take rewritten files for new ones. Without the marker a replay replaces what is there.
    """
    if committed(df.sparkSession, path, batch_tag):
        return
    _write_tagged(df, path, partition_by, batch_tag)
    commit(df.sparkSession, path, batch_tag)


def replace_batch(df: DataFrame, path: str, partition_by: Sequence[str], batch_tag: str) -> None:
    """Write a micro-batch in place of all that earlier attempts of its tag left, in whatever partitions.

    New rows come first and old ones go then, so no crash loses both. For small tables such as logs:
    the driver gets the partitions that ``df`` touches.
    """
    rows = df.select(*partition_by).distinct().collect()
    fs, to_path = file_system(df.sparkSession, path)
    folder = lambda r: "/".join(f"{c}={r[c]}" for c in partition_by)
    written = {to_path(f"{path}/{folder(r)}/{BATCH_TAG}={batch_tag}").toUri().getPath() for r in rows}
    _write_tagged(df, path, partition_by, batch_tag)
    anywhere = "/".join([path, *[f"{c}=*" for c in partition_by], f"{BATCH_TAG}={batch_tag}"])
    for status in fs.globStatus(to_path(anywhere)) or []:
        if status.getPath().toUri().getPath() not in written:
            fs.delete(status.getPath(), True)


def _write_tagged(df: DataFrame, path: str, partition_by: Sequence[str], batch_tag: str) -> None:
    (
        df.withColumn(BATCH_TAG, F.lit(batch_tag))
        .hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, BATCH_TAG)
        .parquet(path)
    )


def committed(spark: SparkSession, path: str, batch_tag: str) -> bool:
    """Whether a micro-batch of a table is complete."""
    return exists(spark, f"{path}{COMMITS}/{batch_tag}")


def commit(spark: SparkSession, path: str, batch_tag: str) -> None:
    mark(spark, f"{path}{COMMITS}/{batch_tag}")


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and a function from text to its paths."""
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there; nothing is listed or read."""
    fs, to_path = file_system(spark, path)
    return fs.exists(to_path(path))


def mark(spark: SparkSession, path: str) -> None:
    """Leave a marker: a folder with an empty ``_SUCCESS``."""
    fs, to_path = file_system(spark, path)
    fs.create(to_path(f"{path}/_SUCCESS"), True).close()


def batch_tag(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch that no other checkpoint shares.

    Batch numbers start over with a new checkpoint, the query id does not repeat. Outside a
    stream there is no such id, and a made-up one could meet that of another stream.
    """
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query_id:
        raise RuntimeError("a batch tag needs the id of a running streaming query")
    return f"{query_id}-{batch_id}"


def drain_to_table(
    stream: DataFrame, path: str, partition_by: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Append everything that has arrived to a table, each batch exactly once, then stop."""

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, partition_by, batch_tag(batch, batch_id))

    return drain_batches(stream, store, checkpoint)


def drain_batches(
    stream: DataFrame,
    batch_function: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> StreamingQuery:
    """Hand everything that has arrived to ``batch_function`` batch by batch, then stop.

    A stateful stream plans without adaptive execution. What a batch function does with its
    batch is ordinary work again, so there the setting of the caller's session holds: writes are
    rebalanced and joins adapt to sizes.
    """
    adaptive = stream.sparkSession.conf.get(_ADAPTIVE)

    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        planned = conf.get(_ADAPTIVE)
        conf.set(_ADAPTIVE, adaptive)
        try:
            batch_function(batch, batch_id)
        finally:
            conf.set(_ADAPTIVE, planned)

    query = (
        stream.writeStream.foreachBatch(run)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 100) -> DataFrame:
    """The first rows in a full order, so that two looks show the same rows."""
    return df.orderBy(*order_by).limit(rows)
