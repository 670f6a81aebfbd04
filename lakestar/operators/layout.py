"""Tables laid out so that a lookup by any of several keys reads few of their files.

Clustering by one key leaves lookups by the others to a full scan. Here each key's values become ranks that cut its rows into
parts of about equal size, the bits of the ranks are interleaved, and rows are range-sorted by the place of that number among
the Gray codes. Neighbours on this curve differ in one bit, that is, in one key, so a file that begins in one cell and ends in the next
is still narrow in all other keys (on a plain Z-order curve it is wide in all). With ``k`` independent keys and ``f`` files a lookup by
one key meets about ``f ** (1 - 1/k)`` of them, up to twice as many where files end within cells. A zone table beside the rows holds
the least and greatest value of each key in each file; a lookup reads it first and opens only the files that may hold its rows. Inside them Parquet's own statistics, dictionaries and, for keys of
many values, bloom filters skip row groups.

Only the layout rests on a sample (``SAMPLE`` rows); which rows a lookup returns does not. A value that a third of all rows
share is split by the other keys (its lookups, and those of values close to it, meet about the share of files that its rows fill), and rows alike in all of them by a hash of the row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# About how many rows the borders of the ranks are taken from.
SAMPLE = 20_000
# A lookup that may meet more files than this reads the table as a whole, with its filter pushed down.
MOST_FILES = 10_000


def borders(df: DataFrame, keys: list[str], bits: int) -> dict[str, list]:
    """Sorted values that cut the rows of each key into ``2 ** bits`` parts; a key without values has none.

    A value of many rows is a border several times, so ranks stay in proportion to rows. At most ``2 ** bits - 1`` values a key reach the driver.
    """
    rows = df.select(*keys)
    share = min(1.0, SAMPLE / max(rows.count(), 1))
    sample = rows if share == 1.0 else rows.sample(share, seed=1)
    parts = 2**bits

    def cut(key: str) -> Column:
        ordered = F.sort_array(F.collect_list(key))
        places = F.sequence(F.lit(1), F.lit(parts - 1))
        return F.array_compact(F.transform(places, lambda i: F.get(ordered, F.floor(i * F.size(ordered) / parts).cast("int"))))

    found = sample.agg(*[cut(k).alias(f"b{i}") for i, k in enumerate(keys)]).first()
    return dict(zip(keys, found))


def rank(value: Column, marks: list, bits: int) -> Column:
    """How many of the sorted borders are not above the value, by binary search; 0 for NULL."""
    if not marks:
        return F.lit(0)
    sorted_marks = F.array(*map(F.lit, marks))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda r, s: r + F.when(F.get(sorted_marks, r + s - 1) <= value, s).otherwise(F.lit(0)))


def interleaved(ranks: list[Column], bits: int) -> Column:
    """The ranks' bits in turn, the highest of all ranks first."""
    n = len(ranks)
    if n * bits > 62:
        raise ValueError(f"{n} keys of {bits} bits do not fit a long")
    spots = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long"), b * n + i) for b in range(bits) for i, r in enumerate(ranks)]
    return reduce(lambda a, b: a.bitwiseOR(b), spots)


def gray_place(code: str) -> Column:
    """The place of a number that is not negative in the sequence of Gray codes."""
    return F.expr(f"aggregate(array(1, 2, 4, 8, 16, 32), {code}, (x, s) -> x ^ shiftright(x, s))")


def write_laid_out(
    df: DataFrame, path: str, keys: list[str], files: int | None = None, bits: int = 8, bloom: dict[str, int] | None = None,
) -> None:
    """Write the rows along the curve of the keys under ``path/rows`` and their zones under ``path/zones``.

    Keys are texts or numbers. ``bloom`` gives for keys of many values how many a file holds about; keys whose values fit Parquet's
    dictionaries need none. ``files`` is left to Spark if not given. An empty table has no zones.
    """
    marks = borders(df, keys, bits)
    names = [f"__rank{i}" for i in range(len(keys))]
    ranked = df.withColumns({n: rank(F.col(k), marks[k], bits) for n, k in zip(names, keys)})
    plain = [n for n, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    # It depends on the row and its input partition only, so a task that runs again places its rows alike.
    coded = ranked.withColumn("__code", interleaved([F.col(n) for n in names], bits))
    placed = coded.withColumns({"__at": gray_place("__code"), "__row": F.xxhash64(*plain) + F.spark_partition_id()})
    order = ["__at", "__row"]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    writer = ranged.sortWithinPartitions("__at", *keys).select(*df.columns).write.mode("overwrite")
    for key, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", values)
    writer.parquet(f"{path}/rows")
    zones(df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows"), keys).write.mode("overwrite").parquet(f"{path}/zones")


def zones(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A row per file of the scan: file, rows, and each key's least and greatest value and number of NULLs.

    Reads the key columns only and combines before its shuffle.
    """
    spans = [f(k).alias(f"{name}_{k}") for k in keys for name, f in (("low", F.min), ("high", F.max), ("blank", lambda c: F.count_if(F.col(c).isNull())))]
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *spans)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def files_for(zone_table: DataFrame, equals: dict) -> DataFrame:
    """The zones that may hold rows with these values; None stands for NULL."""
    return zone_table.where(_all([
        F.col(f"blank_{k}") > 0 if v is None else (F.col(f"low_{k}") <= F.lit(v)) & (F.col(f"high_{k}") >= F.lit(v)) for k, v in equals.items()]))


def lookup(spark: SparkSession, path: str, equals: dict) -> DataFrame:
    """Rows of a table written by ``write_laid_out`` whose keys equal the values; None finds the rows without one.

    The names of the files that may hold them reach the driver, ``MOST_FILES`` at most.
    """
    whole = spark.read.parquet(f"{path}/rows")
    found = files_for(spark.read.parquet(f"{path}/zones"), equals).select("file").limit(MOST_FILES + 1).collect()
    if len(found) > MOST_FILES:
        scan = whole
    elif found:
        scan = spark.read.schema(whole.schema).parquet(*[r.file for r in found])
    else:
        scan = whole.limit(0)
    return scan.where(_all([F.col(k).isNull() if v is None else F.col(k) == F.lit(v) for k, v in equals.items()]))
