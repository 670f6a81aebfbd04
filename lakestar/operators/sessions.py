"""Sessions by inactivity: rows of a key that follow each other within a gap belong together.

``session_window`` needs all rows of a key in one task. In a batch, rows are first
grouped within buckets of time, so a hot key is as many groups as it has buckets, and what comes out are pieces of sessions.
Pieces are then put together: one that starts within the gap after the end of those before it goes on with
their session. That step sees pieces, not rows, and cuts hot keys into slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.operators.asof import carry_last
from lakestar.operators.running import running_sum

DAY = 86_400


def window(at: str, gap_seconds: int) -> Column:
    return F.session_window(at, f"{gap_seconds} seconds")


def sessions(
    rows: DataFrame, key: list[str], at: str, gap_seconds: int, sums: dict[str, Column] | None = None,
    bucket_seconds: int = DAY, hot_rows: int | None = None,
) -> DataFrame:
    """One row per session: key, ``first_at``, ``last_at``, ``rows`` and the ``sums``.

    ``at`` is a timestamp. A row exactly one gap after another still belongs to its session, as in Spark's session windows.
    Rows without a time or a key are in no session.
    """
    sums = sums or {}
    if gap_seconds <= 0:
        raise ValueError("a gap must be above 0 seconds")
    known = rows.dropna("any", subset=[*key, at])
    piece = (
        known.withColumn("__bucket", F.floor(F.unix_seconds(at) / bucket_seconds)).groupBy(*key, "__bucket", window(at, gap_seconds).alias("__window"))
        .agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(n) for n, c in sums.items()])
        .drop("__bucket", "__window"))
    held = carry_last(piece, key, "first_at", F.col("last_at"), "__end", [], hot_rows=hot_rows)
    starts = F.col("__end").isNull() | (F.unix_micros("first_at") - F.unix_micros("__end") > gap_seconds * 1_000_000)
    numbered = running_sum(held, key, "first_at", starts.cast("int"), "__session", descending=False, hot_rows=hot_rows)
    return numbered.groupBy(*key, "__session").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.sum("rows").alias("rows"),
        *[F.sum(n).alias(n) for n in sums]).drop("__session")


def streamed_sessions(stream: DataFrame, key: list[str], at: str, gap_seconds: int, late_seconds: int) -> DataFrame:
    """The sessions of a stream, each given out once it can grow no more.

    State holds the open sessions of the last ``late_seconds`` and a gap; rows that come later than that are left out.
    """
    known = stream.dropna("any", subset=[*key, at]).withWatermark(at, f"{late_seconds} seconds")
    found = known.groupBy(*key, window(at, gap_seconds).alias("__window")).agg(
        F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count(F.lit(1)).alias("rows"))
    return found.select(*key, "first_at", "last_at", "rows")
