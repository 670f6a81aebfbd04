"""Scans of raw files and of the tables written by ``sinks``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.contracts import Contract, conform
from lakestar.sources.sinks import unescaped


def _reader(spark: SparkSession, schema: T.StructType | None, tree: bool, glob: str | None) -> DataFrameReader:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if tree:
        reader = reader.option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", glob) if glob else reader


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, tree: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """JSON lines. With a schema absent fields are NULL; without one it is inferred.

    Inference reads the data twice: use it to explore, declare the schema in jobs.
    ``tree`` walks the whole directory tree, ``glob`` filters file names.
    """
    return _reader(spark, schema, tree, glob).json(path)


def path_schema(paths: Mapping[str, str], types: T.StructType) -> T.StructType:
    """The nested read schema that holds just the given dotted paths."""
    root: dict = {}
    for column, path in paths.items():
        *parents, leaf = path.split(".")
        node = root
        for name in parents:
            node = node.setdefault(name, {})
        node[leaf] = types[column].dataType

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(n, build(v) if isinstance(v, dict) else v) for n, v in node.items()]
        )

    return build(root)


def read_json_paths(
    spark: SparkSession, path: str | list[str], paths: Mapping[str, str], contract: Contract, tree: bool = False
) -> DataFrame:
    """JSON lines with a field-path mapping ``{column: dotted path}``; other fields are not parsed."""
    raw = read_json(spark, path, path_schema(paths, contract.schema), tree)
    return raw.select(*[F.col(paths[c]).alias(c) for c in contract.columns if c in paths])


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, header: bool = True,
    sep: str = ",", infer: bool = False, multi_line: bool = False, tree: bool = False, glob: str | None = None,
) -> DataFrame:
    """Delimited text: declared, inferred or all-string columns, with or without a header.

    ``multi_line`` is for quoted free text with line breaks. Such a file cannot be
    split, so the unit of parallel work is the file.
    """
    reader = _reader(spark, schema, tree, glob).option("header", header).option("sep", sep)
    reader = reader.option("inferSchema", infer).option("quote", '"').option("escape", '"')
    return reader.option("multiLine", multi_line).csv(path)


def read_text(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """Raw lines in column ``value``. A gzip file is one split: ask for ``partitions`` to spread its rows."""
    lines = spark.read.text(path)
    return lines.repartition(partitions) if partitions else lines


def read_table(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """A written table, always from its root so that partition columns come back, with declared types.

    Filters on a partition column still prune folders, as its text depends on nothing else.
    """
    table = spark.read.schema(contract.schema).parquet(root).select(*contract.columns)
    kinds = dict(table.dtypes)
    return table.withColumns({n: unescaped(F.col(n)) for n in contract.partition_by if kinds[n] == "string"})


def stage(df: DataFrame, contract: Contract, root: str, mode: str = "overwrite") -> DataFrame:
    """Bulk-load raw rows into a typed columnar staging table and read it back.

    Later steps scan only the columns they use, instead of parsing the raw text again.
    """
    conform(df, contract).write.mode(mode).parquet(root)
    return read_table(df.sparkSession, root, contract)
