"""Helpers of the operators: saved intermediate tables, row keys, connected components."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.session import apply_runtime_conf, work_dir

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD = r"[^\x20\x09-\x0D]+"
SEPARATOR = r"[\x20\x09-\x0D]+"

# Folders of the tables saved since the innermost ``settled`` began.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime options of these operators: small Arrow batches, so that long texts fit a worker."""
    apply_runtime_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def saved(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read back: it cuts the lineage, survives lost
    executors, and its shuffle files go as soon as it is written."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    if _passing.get() is not None:
        _passing.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """``saved(build())``, after which the tables that ``build`` saved on its way are deleted.

    The result is a written table that no longer reads them. If it fails, they stay. Nothing else may read them
    later, so ``build`` hands out its result only.
    """
    outer = _passing.get()
    mark = _passing.set([])
    try:
        result = saved(build(), label)
        *passing, kept = _passing.get()
    finally:
        _passing.reset(mark)
    if outer is not None:
        outer.append(kept)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in passing:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)
    return result


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def hash_sample(rows: DataFrame, columns: list[str], n: int, total: int) -> DataFrame:
    """At most ``n`` of ``total`` rows, those with the smallest hash of the columns.

    Rows beyond about the ``2n`` smallest hashes are left out in the scan, so what meets in one task is bounded.
    """
    place = F.pmod(F.xxhash64(*columns), F.lit(2**31))
    near = rows.where(place < int(2**31 * min(1.0, 2 * n / max(total, 1))))
    return near.orderBy(place, *columns).limit(n)


def keyed(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, text and text_key; with ``carry`` also ``doc``, a struct of all columns but the text.

    A row is known by id and text: an exact repeat is the same document.
    """
    others = [F.struct(*(named(c) for c in docs.columns if c != "text")).alias("doc")] if carry else []
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("text_key"), *others)


def once(value: Column, use) -> Column:
    """``use(value)`` with the value as a lambda's variable, so that it is made once however often it is used."""
    return F.transform(F.array(value), use)[0]


def named(column: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col(f"`{column}`")


def as_documents(columns: list[str], text: Column) -> list[Column]:
    """The columns of the documents again, from ``doc`` and a text."""
    return [text.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in columns]


def same_row(left: DataFrame, right: DataFrame):
    """Join condition on the row key; a NULL id equals a NULL id."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of edges ``(a, b)``: ``(node, root)`` for every node, root the smallest node.

    Alternating large-star and small-star steps: every step moves edges to smaller
    neighbours and combines before its shuffle. Edges stay in tables, never in the driver.
    """
    edges = saved(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), f"{label}-edges")
    mark = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("x")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        joined = large.join(least, F.col("u") == F.col("x"))
        small = joined.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            joined.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        edges = saved(small, f"{label}-edges")
        now = tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(shiftright(xxhash64(a, b), 32))")).first())
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
