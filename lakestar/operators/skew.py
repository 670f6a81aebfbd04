"""Splitting hot keys.

A key is hot when it holds more rows than a limit. By default the limit is the
total number of rows divided by a few times the shuffle partitions, so a hot key
is one that would overload its partition, and there are at most ``pieces`` of
them whatever the data volume. The table of hot keys therefore has a proven size
bound; it is the only thing these operators broadcast. A limit given by a caller
moves the border between hot and not, and broadcasting is then left to Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Splitting fewer rows than this is not worth the extra stage.
MIN_HOT_ROWS = 10_000
PIECES_PER_PARTITION = 4


def hot_limit(total: DataFrame, hot_rows: int | None = None) -> Column:
    """Rows a key may hold before it is split: ``hot_rows``, or a share of all rows.

    ``total`` is a frame of one number, the row count; it runs as a scalar subquery.
    """
    if hot_rows is not None:
        return F.lit(hot_rows)
    pieces = PIECES_PER_PARTITION * int(total.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.greatest(F.lit(MIN_HOT_ROWS), F.ceil(total.scalar() / F.lit(pieces)))


def spread(n: Column, columns: list[str]) -> Column:
    """A number in [0, n) that differs even between identical rows of different input splits.

    It depends only on the row and on the index of the partition holding it, so a
    re-run task sends every row to the same place.
    """
    return F.pmod(F.xxhash64(*columns) + F.spark_partition_id(), n)


def key_counts(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """Rows per key; combined before the shuffle."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(name))


def _hot_keys(df: DataFrame, key: list[str], cells: str, hot_rows: int | None) -> DataFrame:
    """The hot keys with the number of slices each is cut into; a NULL key counts like any other."""
    counts = key_counts(df, key, "__n")
    # Summing the counts lets the subquery reuse their shuffle instead of reading the log again.
    limit = hot_limit(counts.agg(F.sum("__n")), hot_rows)
    return counts.filter(F.col("__n") > limit).select(*key, F.ceil(F.col("__n") / limit).alias(cells))


def look_up(df: DataFrame, key: list[str], hot: DataFrame, bounded: bool = True) -> DataFrame:
    """Left join to a table of hot keys, broadcast if its size is bounded; NULL meets NULL, as in grouping."""
    names = {k: f"__k{i}" for i, k in enumerate(key)}
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    side = hot.withColumnsRenamed(names)
    return df.join(F.broadcast(side) if bounded else side, same, "left").drop(*names.values())


def _own_slice(df: DataFrame, cells: str) -> Column:
    cut = F.when(F.col(cells).isNotNull(), spread(F.col(cells), df.columns))
    return cut.otherwise(F.lit(0)).cast("int")


def _each_slice(cells: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(cells), F.lit(1)).cast("int") - 1))


def skewed_join(
    left: DataFrame, right: DataFrame, key: list[str], how: str = "left", salt: bool = False, hot_rows: int | None = None
) -> DataFrame:
    """Equi-join of a log, in which a key may be hot, to a table with few rows per key.

    By default the plain join: Spark broadcasts a right side below its threshold, and
    adaptive execution splits the hot partitions of a sort-merge join. That split
    does not reach a right side that was just aggregated on the key and is too big
    to broadcast; ``salt`` serves that case at the price of counting the log's keys:
    log rows of a hot key fall into slices, and the other side's rows for that key
    are repeated once per slice. The rows are the same either way. ``right`` must
    share only the key with ``left``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    right = right.dropna("any", subset=key)  # a NULL key meets nothing
    if not salt:
        return left.join(right, key, how)
    hot = _hot_keys(left, key, "__cells", hot_rows)
    bounded = hot_rows is None
    lrows = look_up(left, key, hot, bounded).withColumn("__slice", _own_slice(left, "__cells")).drop("__cells")
    rrows = look_up(right, key, hot, bounded).withColumn("__slice", _each_slice("__cells")).drop("__cells")
    return lrows.join(rrows, [*key, "__slice"], how).drop("__slice")


def hot_grid(left: DataFrame, right: DataFrame, key: list[str], hot_rows: int | None = None) -> DataFrame:
    """Hot keys of either side with the number of slices each side is cut into.

    A NULL key never matches: left rows with one may be hot, right ones are left out.
    """
    lhot = _hot_keys(left, key, "__lcells", hot_rows)
    rhot = _hot_keys(right.dropna("any", subset=key), key, "__rcells", hot_rows)
    uncut = F.lit(1).cast("bigint")
    sides = lhot.withColumn("__rcells", uncut).unionByName(rhot.withColumn("__lcells", uncut))
    return sides.groupBy(*key).agg(F.max("__lcells").alias("__lcells"), F.max("__rcells").alias("__rcells"))


def fanout_join(
    left: DataFrame, right: DataFrame, key: list[str], how: str = "left", hot_rows: int | None = None,
    grid: DataFrame | None = None,
) -> DataFrame:
    """Equi-join in which one key may be hot on either side, or on both.

    The rows of a hot key are laid out on a grid: left rows fall into ``__lcells``
    slices, right rows into ``__rcells`` slices, and each left slice meets each
    right slice in a task of its own. Every pair meets exactly once. Keys that are
    not hot have a 1 x 1 grid, that is, the plain join; if no key is hot, adaptive
    execution drops the grid lookup altogether. ``right`` must share only the key
    columns with ``left``. Pass ``grid`` (see ``hot_grid``) when cheaper frames
    with the same keys are at hand to count.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    grid = grid if grid is not None else hot_grid(left, right, key, hot_rows)
    right = right.dropna("any", subset=key)
    bounded = hot_rows is None
    lrows = look_up(left, key, grid, bounded).withColumns(
        {"__lslice": _own_slice(left, "__lcells"), "__rslice": _each_slice("__rcells")}
    )
    rrows = look_up(right, key, grid, bounded).withColumns(
        {"__rslice": _own_slice(right, "__rcells"), "__lslice": _each_slice("__lcells"), "__hit": F.lit(True)}
    )
    slices = ["__lslice", "__rslice"]
    joined = lrows.drop("__lcells").join(rrows.drop("__lcells", "__rcells"), [*key, *slices], how)
    if how == "left":
        # A key with several right slices has matches, yet one of its slices may be
        # empty and would then add a spurious unmatched row.
        spurious = (F.coalesce(F.col("__rcells"), F.lit(1)) > 1) & F.col("__hit").isNull()
        joined = joined.filter(~spurious)
    return joined.drop(*slices, "__rcells", "__hit")
