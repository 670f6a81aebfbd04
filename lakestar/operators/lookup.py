"""Natural-key joins between an event log and an entity catalogue.

These are plain equi-joins (``skewed_join``): Spark broadcasts a catalogue below its
threshold, whether or not a key of the log is hot, and beyond it sorts, merges and
splits hot partitions. ``salt`` slices hot keys where that split does not reach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.operators.skew import skewed_join


def natural_key_join(
    log: DataFrame, catalogue: DataFrame, on: dict[str, str], ids: list[str], how: str = "left",
    ambiguous: str = "all", salt: bool = False, hot_rows: int | None = None,
) -> DataFrame:
    """Join on several natural keys (``{log column: catalogue column}``) and add the ids.

    ``ambiguous="all"`` multiplies an event by its matches; ``"first"`` takes the
    smallest id tuple per natural key, so no event is ever multiplied. That side is
    aggregated on the join key: see ``skewed_join`` for ``salt``.
    """
    side = catalogue.select(*[F.col(theirs).alias(ours) for ours, theirs in on.items()], *ids)
    if ambiguous == "first":
        side = smallest_ids(side, list(on), ids)
    elif ambiguous != "all":
        raise ValueError(f"unknown ambiguity rule: {ambiguous}")
    return skewed_join(log, side, list(on), how, salt, hot_rows)


def smallest_ids(catalogue: DataFrame, key: list[str], ids: list[str]) -> DataFrame:
    """One row per natural key, with its smallest id tuple."""
    return catalogue.groupBy(*key).agg(F.min(F.struct(*ids)).alias("__ids")).select(*key, "__ids.*")


def chained_name_join(log: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Match plays by song title and artist name, tied together by the artist id.

    Songs and artists meet first, on the id: joining the log by title alone would
    multiply it by every other artist's song of that title.
    """
    named = songs.select("song_id", "artist_id", F.col("title").alias("song")).join(
        artists.select("artist_id", F.col("name").alias("artist")), "artist_id"
    )
    return skewed_join(log, named, ["song", "artist"], "inner")


def never_seen(all_values: DataFrame, seen: DataFrame) -> DataFrame:
    """Distinct rows of the first frame that are not in the second."""
    return all_values.subtract(seen)


def rows_at_maximum(df: DataFrame, column: str) -> DataFrame:
    """All rows that reach the maximum of a column, ties included."""
    top = df.agg(F.max(column).alias(column))
    # One row by construction, so this broadcast is bounded.
    return df.join(F.broadcast(top), column).select(*df.columns)


def top_k(df: DataFrame, k: int, by: str, tiebreak: list[str]) -> DataFrame:
    """The k largest rows; ties resolved so that the answer is the same every time."""
    return df.orderBy(F.desc(by), *[F.asc(c) for c in tiebreak]).limit(k)
