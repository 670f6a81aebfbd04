"""Table and file writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakestar.contracts import Contract, conform


# Fixed value: starts an escaped partition value; alone it stands for blank text.
ESCAPE = "\\"


def escaped(value: Column) -> Column:
    """A text partition value as it goes into a folder name."""
    return F.when(value == "", ESCAPE).when(F.startswith(value, F.lit(ESCAPE)), F.concat(F.lit(ESCAPE), value)).otherwise(value)


def unescaped(value: Column) -> Column:
    """The text that ``escaped`` wrote."""
    return F.when(F.startswith(value, F.lit(ESCAPE)), F.substring(value, F.lit(2), F.length(value))).otherwise(value)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> int:
    """Parquet write, optionally hive-partitioned; returns the number of rows written.

    Before a partitioned write rows are brought together by partition key with a
    REBALANCE: like a repartition it avoids a small file per task and key, but
    adaptive execution splits a key that holds much of the data over many tasks.
    Rows are counted on the way to the files, so nothing is computed twice. Blank text in a
    partition column is written escaped, for a folder name cannot tell it from NULL;
    ``files.read_table`` turns it back.
    """
    if partition_by:
        kinds = dict(df.dtypes)
        df = df.withColumns({n: escaped(F.col(n)) for n in partition_by if kinds[n] == "string"})
        df = df.hint("rebalance", *partition_by)
    written = Observation()
    df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return written.get["rows"]


def write_table(df: DataFrame, contract: Contract, path: str, mode: str = "overwrite") -> int:
    """Conform to the contract and write with its partitioning; returns the rows written."""
    return write_parquet(conform(df, contract), path, contract.partition_by, mode)


def write_clustered(df: DataFrame, contract: Contract, path: str, partitions: int | None = None) -> None:
    """Write in clustering order, so that point lookups skip most row groups.

    Range partitioning on the whole key also splits the rows of one hot leading key.
    """
    key = list(contract.key)
    rows = conform(df, contract)
    ranged = rows.repartitionByRange(partitions, *key) if partitions else rows.repartitionByRange(*key)
    ranged.sortWithinPartitions(*key).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, quote_all: bool = False, sep: str = ",") -> None:
    writer = df.write.mode("overwrite").option("header", header).option("sep", sep)
    writer.option("quoteAll", quote_all).option("escape", '"').csv(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Name frames so that ``spark.sql`` can use them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
