"""Running totals per key and the phase / period labels built on them.

A plain window puts all rows of a key into one task. Here the rows of a hot key
are cut into consecutive slices of the order column; a slice gets the total of
the rows before it as a start value and is summed on its own.

One aggregate per key and bucket of the order column, combined before its
shuffle, gives row counts and totals. Slices are runs of buckets with about equal
row counts, so a far outlier gets a slice of its own and moves no other border.
The log is scanned twice: for that aggregate and for the sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.operators.skew import hot_limit

HOUR_MILLIS = 3_600_000
LOWEST = -(2**63)
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _position(df: DataFrame, order: str) -> tuple[Column, int]:
    """The order column as a number that sorts the same way, and the width of a bucket of it.

    A bucket is an hour of a timestamp, a day of a date, and 3,600,000 of a plain
    number (an hour in milliseconds).
    """
    kind = df.schema[order].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(order).cast("timestamp")), HOUR_MILLIS * 1000
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(order)), HOUR_MILLIS * 1000
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(order)), 1
    return F.col(order), HOUR_MILLIS


def running_sum(
    df: DataFrame,
    key: list[str],
    order: str,
    value: Column,
    name: str,
    descending: bool = True,
    frame: str = "range",
    tiebreak: list[str] | None = None,
    hot_rows: int | None = None,
    bucket: int | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` from the first row of the key to this row.

    ``frame="range"`` gives rows with equal ``order`` the same value;
    ``frame="rows"`` counts row by row and needs ``tiebreak`` columns that make
    the order total. ``value`` must be of a whole-number type: sums of fractions would
    depend on the slices. NULL values count as in Spark's own window: they are
    left out, and the sum is NULL until the first value. ``bucket`` is the width of a
    bucket of the order column; rows of one bucket stay in one slice. The order column must be a
    number, date or time.
    """
    if frame == "rows" and not tiebreak:
        raise ValueError("a rows frame needs tiebreak columns, or the result depends on row order")
    position, width = _position(df, order)
    rows = df.withColumns({"__pos": position, "__value": value})
    kind = rows.schema["__value"].dataType
    if not (isinstance(kind, WHOLE) or isinstance(kind, T.DecimalType) and kind.scale == 0):
        raise TypeError(f"a running sum needs whole numbers, not {kind.simpleString()}")
    direction = F.desc if descending else F.asc
    if not isinstance(rows.schema["__pos"].dataType, T.NumericType):
        raise TypeError(f"{order} cannot be cut into slices: {rows.schema['__pos'].dataType.simpleString()}")
    # NULL positions sort below all others, in either direction.
    number = F.coalesce(F.floor(F.col("__pos") / F.lit(bucket or width)).cast("bigint"), F.lit(LOWEST))
    rows = rows.withColumn("__bucket", number)

    slices = _slices(rows, key, direction, hot_rows).withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(key)})
    mine = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)]
    # At most two slices for each piece of the log that ``hot_limit`` allows by default, so this table is bounded.
    side = F.broadcast(slices) if hot_rows is None else slices
    placed = rows.join(side, [*mine, F.col("__bucket").between(F.col("__low"), F.col("__high"))], "left")

    within = Window.partitionBy(*key, "__slice")
    if frame == "rows":
        ordering = [direction("__pos"), *[F.asc(c) for c in tiebreak]]
        within = within.orderBy(*ordering).rowsBetween(Window.unboundedPreceding, 0)
    else:
        within = within.orderBy(direction("__pos")).rangeBetween(Window.unboundedPreceding, 0)
    own = F.sum("__value").over(within)
    total = F.when(F.col("__start").isNull(), own).otherwise(F.coalesce(own, F.lit(0)) + F.col("__start"))
    return placed.withColumn(name, total).select(*df.columns, name)


def _slices(rows: DataFrame, key: list[str], direction, hot_rows: int | None) -> DataFrame:
    """Slices of the hot keys: first and last bucket, and the total of what comes before."""
    sums = rows.groupBy(*key, "__bucket").agg(F.count(F.lit(1)).alias("__n"), F.sum("__value").alias("__total"))
    limit = hot_limit(sums.agg(F.sum("__n")), hot_rows)
    before = Window.partitionBy(*key).orderBy(direction("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        sums.withColumn("__all", F.sum("__n").over(Window.partitionBy(*key)))
        .withColumns({"__ahead": F.coalesce(F.sum("__n").over(before), F.lit(0)), "__start": F.sum("__total").over(before)})
        .filter(F.col("__all") > limit)
        .withColumn("__slice", F.floor(F.col("__ahead") / limit))
    )
    return runs.groupBy(*key, "__slice").agg(
        F.min("__bucket").alias("__low"), F.max("__bucket").alias("__high"), F.min_by("__start", "__ahead").alias("__start"))


def label_by_anchor(
    df: DataFrame, key: list[str], order: str, page: str, anchor: str, name: str, **options
) -> DataFrame:
    """Label each row with the number of anchor pages at or after it, per key."""
    flag = F.when(F.col(page) == anchor, F.lit(1)).otherwise(F.lit(0))
    return running_sum(df, key, order, flag, name, **options)


def mean_rows_between_anchors(
    df: DataFrame, key: list[str], order: str, page: str, counted: str, anchor: str, **options
) -> DataFrame:
    """One row: the mean number of ``counted`` rows per period between ``anchor`` rows.

    Periods without a counted row do not enter the mean.
    """
    narrow = df.filter(F.col(page).isin(counted, anchor)).select(
        *dict.fromkeys([*key, order, page, *(options.get("tiebreak") or [])])
    )
    periods = label_by_anchor(narrow, key, order, page, anchor, "period", **options)
    per_period = periods.filter(F.col(page) == counted).groupBy(*key, "period").agg(F.count(F.lit(1)).alias("n"))
    return per_period.agg(F.avg("n").alias("mean_rows"))
