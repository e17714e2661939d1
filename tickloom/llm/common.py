"""What the operators share: tables in the shared folder, packed rows, connected components."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.config import shared_folder
from tickloom.sinks.files import file_system

#: What separates words, as a regular expression, and the words themselves.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The columns as one struct, so that names of an operator's own columns can't clash."""
    names = df.columns if columns is None else columns
    return F.struct(*[col(c).alias(c) for c in names]) if names else F.struct(F.lit(None).alias("nothing"))


def unpacked(df: DataFrame, struct: str, columns: list[str]) -> list[Column]:
    """The columns of a struct made by :func:`packed`."""
    return [F.col(struct).getField(c).alias(c) for c in columns]


def with_results(df: DataFrame, struct: str, columns: list[str], results: dict[str, Column]) -> DataFrame:
    """The packed columns and the results; a result takes the place of a column of its name."""
    taken = {c.lower() for c in results}
    keep = [c for c in columns if c.lower() not in taken]
    return df.select(*unpacked(df, struct, keep), *[value.alias(name) for name, value in results.items()])


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it: lineage ends, and all executors see it."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(table: DataFrame, purpose: str) -> None:
    """Delete the files of a table that :func:`materialise` wrote for this purpose, once nothing reads it any more."""
    for path in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        if path.rsplit("/", 1)[1].startswith(f"{purpose}-"):
            fs, to_path = file_system(table.sparkSession, path)
            fs.delete(to_path(path), True)


def bucketed(df: DataFrame, key: str, purpose: str) -> str:
    """Name of a table in the shared folder whose rows are dealt by ``key``, so that joins on it move the other side only.

    Whoever asks for it drops the table from the catalog; its files stay as those of :func:`materialise`.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    name = "tickloom_" + path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name, format="parquet")
    return name


def numbered(docs: DataFrame, purpose: str) -> DataFrame:
    """The rows of a table as (uid, row), written once, so that a row keeps its number."""
    return materialise(docs.select(F.monotonically_increasing_id().alias("uid"), packed(docs).alias("row")), purpose)


def placed(docs: DataFrame, purpose: str) -> DataFrame:
    """The rows of a table as (uid, row), so that each row is found again when the table is read again.

    Rows of Parquet files are known by file and place there, and nothing is copied; files must stay as
    they are, and a table made of them must give the same rows again. Rows of other tables, and of
    tables that repeat places of files (joins, lists made rows), are written once under numbers.
    """
    try:
        own = docs.metadataColumn("_metadata")
        rows = docs.select(F.struct(own["file_path"].alias("file"), own["row_index"].alias("place")).alias("uid"), packed(docs).alias("row"))
        if rows.groupBy("uid").count().where("count > 1").isEmpty():
            return rows
    except AnalysisException:  # no files, several tables of files, or files of another kind
        pass
    return numbered(docs, purpose)


def sums_before(sums: DataFrame, group: list[str], key: str, value: str, out: str, span: int = 1024) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of smaller ``key``, a whole number from 0, within ``group``.

    Sums of spans of keys are added up first, then the keys inside each span, so that no window holds
    more than one row a span or one span. Keys are distinct within a group; null groups are groups.
    """
    wide = sums.withColumn("span", F.floor(F.col(key) / F.lit(span)))
    tops = wide.groupBy(*group, "span").agg(F.sum(value).alias("top"))
    before = Window.partitionBy(*group).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    keys = [*group, "span"]
    tops = tops.select(*[F.col(c).alias(f"span_of_{c}") for c in keys], F.coalesce(F.sum("top").over(before), F.lit(0)).alias("spans_before"))
    wide = wide.join(tops, [F.col(c).eqNullSafe(F.col(f"span_of_{c}")) for c in keys])
    inside = Window.partitionBy(*keys).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    found = F.col("spans_before") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return wide.withColumn(out, found).select(*sums.columns, out)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the graph with edges (a, b): rows (node, component), its smallest node.

    Alternates large-star and small-star steps until nothing changes; every step moves ends to smaller nodes. Every step is a minimum per
    node, combined before the shuffle, and a join back, whose hot nodes adaptive execution splits;
    no neighbour list is gathered. The edges of each round are a table in the shared folder; the
    driver sees one truth value a round. Null ends and loops are ignored.
    """
    edges = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialise(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
    labelled = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labelled.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether all edges are stars: each node has one edge, and to a node that has none of its own."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.coalesce(F.bool_or(F.expr("up > 1 or up = 1 and down = 1")), F.lit(False))).first()[0] is False


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
