"""Word counting and annotation arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two proper-noun tags.
PROPER_NOUN_TAGS = ("NNP", "NNPS")


def words(text: Column, lower: bool = False) -> Column:
    """Split on runs of white space; a leading blank yields an empty word."""
    return F.split(F.lower(text) if lower else text, r"\s+")


def word_count(df: DataFrame, text: Column, lower: bool = False, keep_empty: bool = True) -> DataFrame:
    """Rows ``(word, count)``. Counts combine before the shuffle, so hot words stay cheap."""
    exploded = df.select(F.explode(words(text, lower)).alias("word"))
    if not keep_empty:
        exploded = exploded.filter(F.col("word") != "")
    return exploded.groupBy("word").count()


def tagged_words(df: DataFrame, annotations: str, tags: tuple[str, ...] = PROPER_NOUN_TAGS) -> DataFrame:
    """Rows ``(word, tag)`` of ``array<struct<result, metadata map>>`` with one of the tags.

    The array is filtered before it is exploded: only kept annotations become rows.
    """
    kept = F.filter(F.col(annotations), lambda a: a["result"].isin(*tags))
    return df.select(F.explode(kept).alias("a")).select(
        F.try_element_at(F.col("a.metadata"), F.lit("word")).alias("word"), F.col("a.result").alias("tag")
    )
