"""Corpus pipeline: quality, boilerplate lines, near copies, source mix, piece ids.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result as
Parquet to the shared folder and reads it back as the next stage's documents. All stages but
the last return the columns of the documents they got. Rows are known by doc_id and text. An
empty table stays empty; extra columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.curriculum import copies, mix
from lakestar.llm.jaccard_join import near_components
from lakestar.llm.line_dedup import drop_recurring_lines
from lakestar.llm.piece_trie import encode
from lakestar.llm.quality_model import THRESHOLD, score, train
from lakestar.llm.shared import as_documents, named, prepare, saved, table

ID, TEXT_KEY, VALUE = "__id", "__text_key", "__value"


def with_values(docs: DataFrame, values: DataFrame, how: str) -> DataFrame:
    """Documents beside ``values (ID, TEXT_KEY, ...)`` of the same id and text; a NULL id equals a NULL id."""
    known = docs.withColumn(ID, F.col("doc_id").cast("long")).withColumn(TEXT_KEY, F.xxhash64(F.col("text").cast("string")))
    return known.join(values, known[ID].eqNullSafe(values["v_id"]) & (known[TEXT_KEY] == values["v_key"]), how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    prepare(spark)
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")), carry=True)
    return scored.where(F.col("score") >= THRESHOLD).select(*as_documents(docs.columns, F.col("text")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; a document of nothing but such lines goes."""
    prepare(spark)
    cleaned = drop_recurring_lines(docs, carry=True)
    kept = cleaned.where((F.col("n_dropped") == 0) | (F.trim("kept_text") != ""))
    return kept.select(*as_documents(docs.columns, F.col("kept_text")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join: the one with the smallest id.

    Documents are near copies from a Jaccard index of 0.8 on shingles of five words.
    """
    prepare(spark)
    first = near_components(docs, k=5, share=(80, 100)).where("is_first").select(F.col("doc_id").alias("v_id"), F.col("text_key").alias("v_key")).distinct()
    return with_values(docs, first, "inner").dropDuplicates([ID, TEXT_KEY]).select(*map(named, docs.columns))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at their training positions: as often as the mix takes them, in curriculum order.

    A document is taken whole: what the mix takes of it in part counts as a copy from half its words on.
    """
    prepare(spark)
    planned = mix(docs).dropDuplicates(["doc_id", "text_key"])
    places = copies(planned).where(2 * F.col("words") >= F.col("size")).select(
        F.col("doc_id").alias("v_id"), F.col("text_key").alias("v_key"), F.col("position").alias(VALUE), F.col("round").alias("__round"))
    return with_values(docs, places, "inner").orderBy(VALUE, ID, "__round").select(*map(named, docs.columns))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with piece ids in place of the text."""
    return encode(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("source mix", source_mix),
    ("piece ids", pieces),
]

#: Hinge-loss fit, digests of the join and piece ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
