"""The last value before a row, as-of joins and interval histories, with hot keys cut into slices.

Everything rests on ``carry_last``: rows of a key in order, each with the last value that is not
NULL among the rows before it. A hot key is cut into consecutive slices of the order column, as for running sums;
a slice starts with the last value of the slices before it, which an aggregate per key and bucket gives.
An as-of join is one sort of both sides in one frame, not a join: the right rows carry a value, the left rows take what was
carried to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.operators.running import LOWEST, _position
from lakestar.operators.skew import hot_limit


def carry_last(
    df: DataFrame, key: list[str], order: str, value: Column, name: str, tiebreak: list[str],
    descending: bool = False, hot_rows: int | None = None, bucket: int | None = None,
) -> DataFrame:
    """Add ``name``: the last ``value`` that is not NULL among the rows before this one; NULL if there is none.

    Rows of a key stand in the order of ``order``, then ``tiebreak`` (ascending whichever way ``order`` runs; NULL first, or
    last if ``descending``). ``order`` must be a number, date or time. Rows of one bucket of it stay in one slice.
    """
    position, width = _position(df, order)
    rows = df.withColumns({"__pos": position, "__value": value})
    if not isinstance(rows.schema["__pos"].dataType, T.NumericType):
        raise TypeError(f"{order} cannot be cut into slices: {rows.schema['__pos'].dataType.simpleString()}")
    number = F.coalesce(F.floor(F.col("__pos") / F.lit(bucket or width)).cast("bigint"), F.lit(LOWEST))
    rows = rows.withColumn("__bucket", number)
    direction = F.desc_nulls_last if descending else F.asc_nulls_first
    ordering = [direction("__pos"), *[F.asc_nulls_first(c) for c in tiebreak]]

    slices = _slices(rows, key, direction, tiebreak, descending, hot_rows).withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(key)})
    mine = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)]
    side = F.broadcast(slices) if hot_rows is None else slices  # with the limit's default there are few slices
    placed = rows.join(side, [*mine, F.col("__bucket").between(F.col("__low"), F.col("__high"))], "left")
    before = Window.partitionBy(*key, "__slice").orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
    own = F.last("__value", ignorenulls=True).over(before)
    return placed.withColumn(name, F.coalesce(own, F.col("__start"))).select(*df.columns, name)


def _slices(rows: DataFrame, key: list[str], direction, tiebreak: list[str], descending: bool, hot_rows: int | None) -> DataFrame:
    """Slices of the hot keys: first and last bucket, and the last value before the slice."""
    there = F.col("__value").isNotNull()
    place = F.struct(*([-F.col("__pos")] if descending else [F.col("__pos")]), *[F.col(c).alias(f"__t{i}") for i, c in enumerate(tiebreak)])
    if descending:
        place = F.struct(F.col("__pos").isNull(), place)
    sums = rows.withColumn("__place", place).groupBy(*key, "__bucket").agg(
        F.count(F.lit(1)).alias("__n"), F.max(F.when(there, F.struct("__place", F.col("__value").alias("value")))).alias("__last"))
    limit = hot_limit(sums.agg(F.sum("__n")), hot_rows)
    before = Window.partitionBy(*key).orderBy(direction("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        sums.withColumn("__all", F.sum("__n").over(Window.partitionBy(*key)))
        .withColumns({"__ahead": F.coalesce(F.sum("__n").over(before), F.lit(0)), "__held": F.last("__last", ignorenulls=True).over(before)})
        .filter(F.col("__all") > limit)
        .withColumn("__slice", F.floor(F.col("__ahead") / limit)))
    return runs.groupBy(*key, "__slice").agg(
        F.min("__bucket").alias("__low"), F.max("__bucket").alias("__high"),
        F.min(F.struct("__ahead", F.col("__held").getField("value").alias("value"))).getField("value").alias("__start"))


def as_of_join(
    left: DataFrame, right: DataFrame, key: list[str], at: tuple[str, str], values: list[str], tiebreak: list[str],
    hot_rows: int | None = None, bucket: int | None = None,
) -> DataFrame:
    """Left rows with the ``values`` of the last right row of their key at or before their time.

    ``at`` names the time of either side; of right rows at one time the last by ``tiebreak`` counts. Right rows without a time
    or a key are left out; left rows are all kept, with NULL where nothing was valid yet.
    """
    mine, theirs = at
    kept = [F.col(c) for c in left.columns]
    packed = F.struct(*values)
    sides = left.select(*key, F.col(mine).alias("__at"), F.lit(1).alias("__side"), F.struct(*kept).alias("__left"))
    changes = right.dropna("any", subset=[*key, theirs]).select(
        *key, F.col(theirs).alias("__at"), F.lit(0).alias("__side"), packed.alias("__right"), *[F.col(c).alias(f"__by{i}") for i, c in enumerate(tiebreak)])
    both = changes.unionByName(sides, allowMissingColumns=True)
    carried = carry_last(both, key, "__at", F.col("__right"), "__held", ["__side", *[f"__by{i}" for i in range(len(tiebreak))]],
                         hot_rows=hot_rows, bucket=bucket)
    return carried.where("__side = 1").select("__left.*", *[
        F.when(F.col("__at").isNotNull(), F.col(f"__held.{v}")).alias(v) for v in values])


def interval_history(
    rows: DataFrame, key: list[str], at: str, value: str, tiebreak: list[str], hot_rows: int | None = None, bucket: int | None = None,
) -> DataFrame:
    """One row per change of a value: key, value, ``valid_from``, ``valid_to`` (NULL for the last one).

    A row that repeats the value before it changes nothing; of rows at one time the last by ``tiebreak`` counts. Rows without
    a key, a time or a value are left out.
    """
    known = rows.dropna("any", subset=[*key, at, value])
    last = known.groupBy(*key, at).agg(F.max(F.struct(*tiebreak, value)).getField(value).alias(value))
    before = carry_last(last, key, at, F.col(value), "__before", [], hot_rows=hot_rows, bucket=bucket)
    changes = before.where(F.col("__before").isNull() | (F.col("__before") != F.col(value))).select(*key, value, F.col(at).alias("valid_from"))
    return carry_last(changes, key, "valid_from", F.col("valid_from"), "valid_to", [], descending=True, hot_rows=hot_rows, bucket=bucket)
