"""Column statistics, missing values and duplicate keys, as small report frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _unpivot(aggregates: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """One wide row of aggregates to one row per column."""
    return aggregates.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias(label), F.col(f"`{n}`").alias(value)) for n in names])).alias("r")
    ).select("r.*")


def missing_percent(df: DataFrame, digits: int = 0) -> DataFrame:
    """Rows ``(column, pct_missing)``: all columns in one pass over the data; NaN is missing too."""
    kinds = dict(df.dtypes)

    def absent(c: str) -> Column:
        column = F.col(f"`{c}`")
        return column.isNull() | F.isnan(column) if kinds[c] in ("float", "double") else column.isNull()

    share = [F.round(F.avg(absent(c).cast("double")) * 100, digits).alias(c) for c in df.columns]
    return _unpivot(df.agg(*share), df.columns, "column", "pct_missing")


def duplicate_count(df: DataFrame, key: list[str], name: str = "duplicates") -> DataFrame:
    """One row: how many rows repeat a key that an earlier row has; NULL is a key too."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))


def describe_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``(column, count, mean, stddev, min, max)`` from one pass; text counts as far as it is numbers."""

    def stats(c: str) -> Column:
        x = F.col(c).try_cast("double")
        return F.struct(
            F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev(x).alias("stddev"),
            F.min(x).alias("min"), F.max(x).alias("max"),
        ).alias(c)

    return _unpivot(df.agg(*[stats(c) for c in columns]), columns, "column", "s").select("column", "s.*")


def describe_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows ``(column, count, mean, stddev, min, max)`` for numbers and text, from one pass.

    Count and extremes are those of the column itself, extremes written as text; mean and
    deviation are NULL unless the values are numbers.
    """

    def stats(c: str) -> Column:
        own, x = F.col(f"`{c}`"), F.col(f"`{c}`").try_cast("double")
        return F.struct(
            F.count(own).alias("count"), F.avg(x).alias("mean"), F.stddev(x).alias("stddev"),
            F.min(own).cast("string").alias("min"), F.max(own).cast("string").alias("max"),
        ).alias(c)

    names = columns or [n for n, kind in df.dtypes if kind == "string" or isinstance(df.schema[n].dataType, T.NumericType)]
    return _unpivot(df.agg(*[stats(n) for n in names]), names, "column", "s").select("column", "s.*")


def profile(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Completeness and duplicates of several tables: ``(table, column, metric, value)``.

    ``tables`` maps a name to its frame and the key whose repeats are counted.
    """
    reports = []
    for name, (df, key) in tables.items():
        missing = missing_percent(df).select(
            F.lit(name).alias("table"), "column", F.lit("pct_missing").alias("metric"),
            F.col("pct_missing").alias("value"),
        )
        repeats = duplicate_count(df, key).select(
            F.lit(name).alias("table"), F.lit(",".join(key)).alias("column"), F.lit("duplicates").alias("metric"),
            F.col("duplicates").cast(T.DoubleType()).alias("value"),
        )
        reports += [missing, repeats]
    return reduce(DataFrame.unionByName, reports)
