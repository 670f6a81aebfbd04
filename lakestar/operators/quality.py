"""Data-quality checks. Each returns rows ``(check, table, detail, bad)``; 0 bad is a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.contracts import Contract


class QualityError(ValueError):
    """A check found bad rows."""


def _finding(counted: DataFrame, check: str, table: str, detail: str) -> DataFrame:
    return counted.select(
        F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(detail).alias("detail"),
        F.coalesce(F.col("bad"), F.lit(0)).cast("long").alias("bad"),
    )


def row_parity(expected: int, after: DataFrame, table: str) -> DataFrame:
    """How many rows a table holds more or fewer than were written to it."""
    counted = after.agg(F.abs(F.count(F.lit(1)) - F.lit(expected)).alias("bad"))
    return _finding(counted, "row_parity", table, "rows")


def not_empty(df: DataFrame, table: str) -> DataFrame:
    counted = df.limit(1).agg((1 - F.count(F.lit(1))).alias("bad"))
    return _finding(counted, "not_empty", table, "rows")


def _key_repeats(key: list[str]) -> Column:
    """Over rows ``(key, n)``: rows with a NULL key part plus rows beyond the first of a key."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return F.sum(F.when(null_key, F.col("n")).otherwise(F.col("n") - 1))


def _rows_of(counts: DataFrame, table: str, found: list[tuple[str, str, str]]) -> DataFrame:
    """One wide row of counts to a finding per ``(check, detail, count column)``."""
    cells = [
        F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(detail).alias("detail"),
                 F.coalesce(F.col(column), F.lit(0)).cast("long").alias("bad"))
        for check, detail, column in found
    ]
    return counts.select(F.explode(F.array(*cells)).alias("f")).select("f.*")


def primary_key(df: DataFrame, key: list[str], table: str) -> DataFrame:
    """Rows with a NULL key part plus rows beyond the first of a key."""
    return keys_and_nulls(df, key, [], table)


def not_null(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """NULLs per column that must have none, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
    return _rows_of(counts, table, [("not_null", c, f"null_{c}") for c in columns])


def keys_and_nulls(df: DataFrame, key: list[str], columns: list[str], table: str) -> DataFrame:
    """Key and NULL checks from a single scan: NULLs are counted per key on the way."""
    nulls = {c: f"null_{c}" for c in columns}
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(n) for c, n in nulls.items()]
    )
    counts = per_key.agg(_key_repeats(key).alias("repeats"), *[F.sum(n).alias(n) for n in nulls.values()])
    found = [("primary_key", ",".join(key), "repeats"), *[("not_null", c, n) for c, n in nulls.items()]]
    return _rows_of(counts, table, found)


def references(child: DataFrame, column: str, parent: DataFrame, parent_column: str, table: str) -> DataFrame:
    """Rows whose foreign key has no parent; a NULL key refers to nothing and passes.

    Child keys are counted first, so a hot foreign key joins as a single row.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    orphans = keys.join(parent.select(F.col(parent_column).alias("k")), "k", "left_anti")
    return _finding(orphans.agg(F.sum("n").alias("bad")), "references", table, f"{column}->{parent_column}")


def schema_matches(df: DataFrame, contract: Contract) -> DataFrame:
    """One finding per contract column: 1 if it is absent or of another type."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    bad = [(f.name, int(actual.get(f.name) != f.dataType)) for f in contract.schema.fields]
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("detail"), F.lit(b).alias("bad")) for n, b in bad]))
    one = df.sparkSession.range(1).select(rows.alias("r")).select("r.*")
    return one.select(
        F.lit("schema").alias("check"), F.lit(contract.name).alias("table"), "detail", F.col("bad").cast("long")
    )


def contract_findings(df: DataFrame, contract: Contract) -> DataFrame:
    """Schema, key and NULL checks a contract implies."""
    key, required = list(contract.key), list(contract.not_null)
    parts = [schema_matches(df, contract)]
    if key:
        parts.append(keys_and_nulls(df, key, required, contract.name))
    elif required:
        parts.append(not_null(df, required, contract.name))
    return reduce(DataFrame.unionByName, parts)


def flag_valid(df: DataFrame, constraints: list[Column], name: str = "valid") -> DataFrame:
    """Add whether a row satisfies every constraint. NULL counts as not satisfied."""
    return df.withColumn(name, F.coalesce(reduce(lambda a, b: a & b, constraints), F.lit(False)))


def split_valid(df: DataFrame, constraints: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every constraint, and the rejected rest."""
    flagged = flag_valid(df, constraints, "__valid")
    return flagged.filter("__valid").drop("__valid"), flagged.filter("NOT __valid").drop("__valid")


def assert_clean(findings: DataFrame) -> None:
    """Raise if any check found bad rows. Findings are one row per check, never data."""
    failed = findings.filter(F.col("bad") > 0).collect()
    if failed:
        raise QualityError("; ".join(f"{r.check} {r.table}.{r.detail}: {r.bad}" for r in failed))
