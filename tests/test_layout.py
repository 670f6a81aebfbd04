"""Curve layout: lookups against plain filters, files met, hot values, NULLs and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from lakestar.operators.layout import borders, files_for, gray_place, interleaved, lookup, rank, write_laid_out, zones

KEYS = ["user", "session", "title"]
SCHEMA = "user int, session bigint, title string, n int"


def made(spark, n=6000, hot=0.0, seed=1):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        user = 7 if pick.random() < hot else pick.choice([None, *range(200)])
        rows.append((user, pick.randrange(500), pick.choice([None, "", *[f"Song number {j}" for j in range(300)]]), i))
    return spark.createDataFrame(rows, SCHEMA), rows


def found(df):
    return sorted(r.n for r in df.collect())


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_lookups_equal_filters_and_meet_few_files(spark, tmp_path, hot):
    df, rows = made(spark, hot=hot)
    path = str(tmp_path / "t")
    write_laid_out(df, path, KEYS, files=64)
    table = spark.read.parquet(f"{path}/zones")
    assert table.agg(F.sum("rows")).first()[0] == len(rows)
    for equals in [{"user": 7}, {"user": 8}, {"user": None}, {"session": 77}, {"title": "Song number 5"}, {"title": ""}, {"title": None},
                   {"user": 7, "session": rows[0][1]}, {"user": 9, "title": "Song number 1"}, {"user": -1}, {"title": "zzz"}]:
        expected = sorted(r[3] for r in rows if all(r[SCHEMA_AT[k]] == v for k, v in equals.items()))
        assert found(lookup(spark, path, equals)) == expected, equals
    # About 64 ** (2/3) = 16 files for one key and 64 ** (1/3) = 4 for two; rows as they came meet all or nearly all.
    plain = str(tmp_path / "plain")
    df.repartition(64).write.parquet(plain)
    unsorted = zones(spark.read.parquet(plain), KEYS)
    asked = [({"session": 250}, 32), ({"title": "Song number 5"}, 32), ({"user": 90}, 32), ({"user": 90, "title": "Song number 5"}, 16)]
    near = files_for(table, {"user": 8}).count()  # beside the hot value, which 40 % of rows hold: about half of all files
    assert near <= (36 if hot else 32), near
    met = [(equals, files_for(table, equals).count(), most, files_for(unsorted, equals).count()) for equals, most in asked]
    assert all(n <= most and before >= 60 for _, n, most, before in met), met


SCHEMA_AT = {"user": 0, "session": 1, "title": 2}


def test_a_hot_value_and_equal_rows_are_split(spark, tmp_path):
    same = spark.range(8000, numPartitions=8).select(
        F.lit(1).alias("user"), F.lit(2).cast("long").alias("session"), F.lit("x").alias("title"), (F.col("id") % 50).cast("int").alias("n"))
    path = str(tmp_path / "t")
    write_laid_out(same, path, KEYS, files=8)
    sizes = [r.rows for r in spark.read.parquet(f"{path}/zones").collect()]
    assert sum(sizes) == 8000 and max(sizes) < 3000
    assert lookup(spark, path, {"user": 1, "title": "x"}).count() == 8000


def test_empty_and_null_tables(spark, tmp_path):
    for i, rows in enumerate([[], [(None, None, None, 1)] * 3]):
        path = str(tmp_path / f"t{i}")
        write_laid_out(spark.createDataFrame(rows, SCHEMA), path, KEYS, files=4)
        assert found(lookup(spark, path, {"user": 1})) == []
        assert found(lookup(spark, path, {"user": None})) == [r[3] for r in rows]


def test_bloom_filters_change_no_row(spark, tmp_path):
    df = spark.range(20_000).select(F.col("id").cast("int").alias("user"), F.md5(F.col("id").cast("string")).alias("title"))
    path = str(tmp_path / "t")
    write_laid_out(df, path, ["user", "title"], files=4, bloom={"title": 5000})
    name = df.where("user = 77").first().title
    assert [r.user for r in lookup(spark, path, {"title": name}).collect()] == [77]


def test_ranks_and_curve(spark):
    df, rows = made(spark, 3000)
    marks = borders(df, KEYS, 5)
    assert all(v == sorted(v) and len(v) == 31 for v in marks.values())
    ranked = df.select("*", *[rank(F.col(k), marks[k], 5).alias(f"r_{k}") for k in KEYS]).withColumn(
        "z", interleaved([F.col(f"r_{k}") for k in KEYS], 5)).withColumn("at", gray_place("z")).collect()
    for r in ranked:
        own = [sum(m <= r[k] for m in marks[k]) if r[k] is not None else 0 for k in KEYS]
        assert own == [r[f"r_{k}"] for k in KEYS]
        assert r.z == sum((v >> b & 1) << (b * 3 + i) for i, v in enumerate(own) for b in range(5))
        assert r.at ^ r.at >> 1 == r.z
    with pytest.raises(ValueError):
        interleaved([F.lit(1)] * 8, 8)
