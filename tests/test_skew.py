"""Hot keys: the split paths must give what the plain ones give."""

import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestar.contracts import struct
from lakestar.operators.running import _slices, label_by_anchor, mean_rows_between_anchors, running_sum
from lakestar.operators.skew import fanout_join, hot_grid, hot_limit, skewed_join


def skewed_log(n=900, seed=7):
    """A third of the rows on one key, a third on NULL, ties and NULL positions."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        user = rng.choice([1, 1, 1, None, None, None, 2, 3, 4])
        pos = None if rng.random() < 0.03 else rng.choice([5, rng.randrange(0, 40), rng.randrange(0, 5000)])
        out.append((i, user, pos, rng.choice(["Home", "NextSong", "Help"])))
    return out


LOG = struct("id int, user int, pos bigint, page string")


def brute_range(data, descending=True):
    """Sum of Home flags at or before each row in sort order, ties sharing the value."""

    def low(p):
        return (p is not None, p or 0)

    result = {}
    for i, user, pos, _ in data:
        ahead = [r for r in data if r[1] == user and (low(r[2]) >= low(pos) if descending else low(r[2]) <= low(pos))]
        result[i] = sum(r[3] == "Home" for r in ahead)
    return result


@pytest.mark.parametrize("hot_rows", [10**9, 100, 7, 1])
@pytest.mark.parametrize("descending", [True, False])
def test_running_sum_range(spark, hot_rows, descending):
    data = skewed_log()
    df = spark.createDataFrame(data, LOG).repartition(5)
    flag = F.when(F.col("page") == "Home", 1).otherwise(0)
    got = running_sum(df, ["user"], "pos", flag, "s", descending=descending, hot_rows=hot_rows)
    assert {r.id: r.s for r in got.collect()} == brute_range(data, descending)
    assert got.columns == ["id", "user", "pos", "page", "s"]


@pytest.mark.parametrize("hot_rows", [10**9, 50, 3])
def test_running_sum_rows(spark, hot_rows):
    data = skewed_log(seed=8)
    df = spark.createDataFrame(data, LOG).repartition(5)
    flag = F.when(F.col("page") == "Home", 1).otherwise(0)
    got = running_sum(df, ["user"], "pos", flag, "s", frame="rows", tiebreak=["id"], hot_rows=hot_rows)
    expected, totals = {}, defaultdict(int)
    for i, user, pos, page in sorted(data, key=lambda r: (r[2] is None, -(r[2] or 0), r[0])):
        totals[user] += page == "Home"
        expected[i] = totals[user]
    assert {r.id: r.s for r in got.collect()} == expected


def test_rows_frame_needs_a_total_order(spark):
    df = spark.createDataFrame(skewed_log(10), LOG)
    with pytest.raises(ValueError):
        running_sum(df, ["user"], "pos", F.lit(1), "s", frame="rows")


def test_range_and_rows_differ_on_ties(spark):
    data = [(1, 1, 10, "Home"), (2, 1, 10, "Home"), (3, 1, 5, "NextSong")]
    df = spark.createDataFrame(data, LOG)
    by_range = {r.id: r.p for r in label_by_anchor(df, ["user"], "pos", "page", "Home", "p").collect()}
    by_rows = {
        r.id: r.p
        for r in label_by_anchor(df, ["user"], "pos", "page", "Home", "p", frame="rows", tiebreak=["id"]).collect()
    }
    assert by_range == {1: 2, 2: 2, 3: 2}
    assert by_rows == {1: 1, 2: 2, 3: 2}


@pytest.mark.parametrize("hot_rows", [10**9, 4])
def test_mean_between_anchors_skips_empty_periods(spark, hot_rows):
    pages = ["NextSong", "Home", "Home", "NextSong", "NextSong", "NextSong", "Home"]
    data = [(i, 1, i, p) for i, p in enumerate(pages)] + [(99, 2, 1, "NextSong"), (100, 3, 1, "Home")]
    df = spark.createDataFrame(data, LOG)
    got = mean_rows_between_anchors(df, ["user"], "pos", "page", "NextSong", "Home", hot_rows=hot_rows)
    assert got.first().mean_rows == pytest.approx((1 + 3 + 1) / 3)


def sides(spark, seed=3):
    rng = random.Random(seed)
    left = [(rng.choice([1, 1, 1, None, None, 2, 3, 9]), rng.randrange(3)) for _ in range(200)]
    right = [(rng.choice([1, 1, 2, 2, None, 4]), rng.randrange(4)) for _ in range(120)]
    return (
        spark.createDataFrame(left, "k int, a int").repartition(4),
        spark.createDataFrame(right, "k int, b int").repartition(3),
    )


@pytest.mark.parametrize("hot_rows", [10**9, 40, 5, 1])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_fanout_join(spark, hot_rows, how):
    left, right = sides(spark)
    assert rows(fanout_join(left, right, ["k"], how, hot_rows)) == rows(left.join(right, "k", how))


def test_fanout_join_splits_identical_copies(spark):
    """Copies of one row land in several slices, and no pair is lost or doubled."""
    left = spark.range(300, numPartitions=6).select(F.lit(1).alias("k"), F.lit("x").alias("a"))
    right = spark.range(50, numPartitions=5).select(F.lit(1).alias("k"), F.lit("y").alias("b"))
    got = fanout_join(left, right, ["k"], "left", 10)
    assert got.count() == 300 * 50
    grid = hot_grid(left, right, ["k"], 10).first()
    assert (grid["__lcells"], grid["__rcells"]) == (30, 5)


def test_fanout_join_rejects_other_types(spark):
    left, right = sides(spark)
    with pytest.raises(ValueError):
        fanout_join(left, right, ["k"], "full")


def test_two_column_key(spark):
    left = spark.createDataFrame([(1, "a", 10), (1, "a", 11), (1, "b", 12), (2, None, 13)], "k int, j string, v int")
    right = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 3)], "k int, j string, w int")
    for hot_rows in (1, 10**9):
        got = fanout_join(left, right, ["k", "j"], "left", hot_rows)
        assert rows(got) == rows(left.join(right, ["k", "j"], "left"))


@pytest.mark.parametrize("hot_rows", [10**9, 40, 5, 1])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_skewed_join(spark, hot_rows, how):
    left, right = sides(spark)
    assert rows(skewed_join(left, right, ["k"], how)) == rows(left.join(right, "k", how))
    assert rows(skewed_join(left, right, ["k"], how, True, hot_rows)) == rows(left.join(right, "k", how))
    unique = right.groupBy("k").agg(F.min("b").alias("b"))
    assert rows(skewed_join(left, unique, ["k"], how, True, hot_rows)) == rows(left.join(unique, "k", how))


def test_skewed_join_spreads_a_hot_key_over_tasks(spark):
    """With broadcasts off, identical copies of one hot key end up in several shuffle partitions."""
    left = spark.range(4000, numPartitions=8).select(F.lit(1).alias("k"), F.lit("x").alias("a"))
    right = spark.createDataFrame([(1, "y")], "k int, b string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = skewed_join(left, right, ["k"], "left", True, 100)
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 4000 and len(sizes) > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_default_limit_is_a_share_of_all_rows(spark):
    pieces = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = lambda n: spark.range(1).select(hot_limit(spark.range(n).agg(F.count(F.lit(1)))).alias("x")).first().x
    assert limit(100) == 10_000
    assert limit(pieces * 50_000) == 50_000


def sums(df, hot_rows, **options):
    value = F.when(F.col("v") >= 0, F.col("v"))
    return rows(running_sum(df, ["k"], "pos", value, "s", hot_rows=hot_rows, **options))


@pytest.mark.parametrize("descending", [True, False])
def test_running_sum_is_the_same_hot_or_not(spark, descending):
    """NULL values, NULL positions and one far outlier."""
    data = [(1, i, -1 if i % 3 == 0 else i % 5) for i in range(60)] + [(1, 10**12, 7), (1, None, 2), (1, None, -1), (1, 10**12 + 1, -1)]
    df = spark.createDataFrame(data + [(2, 5, -1), (None, 3, 4)], "k int, pos long, v int")
    plain = sums(df, 10**9, descending=descending, bucket=1)
    for hot_rows in (1, 7):
        assert sums(df, hot_rows, descending=descending, bucket=1) == plain
    window = Window.partitionBy("k").orderBy(F.desc("pos") if descending else F.asc("pos")).rangeBetween(Window.unboundedPreceding, 0)
    assert plain == rows(df.withColumn("s", F.sum(F.when(F.col("v") >= 0, F.col("v"))).over(window)))


def test_an_outlier_moves_no_other_slice(spark):
    data = [(1, i) for i in range(1000)] + [(1, 10**15)]
    df = spark.createDataFrame(data, "k int, pos long").withColumns({"__value": F.lit(1), "__bucket": F.col("pos")})
    found = _slices(df, ["k"], F.desc, 100).collect()
    sizes = [sum(r["__low"] <= p <= r["__high"] for _, p in data) for r in found]
    assert sum(sizes) == 1001 and max(sizes) <= 200


def test_running_sum_takes_whole_numbers_only(spark):
    df = spark.createDataFrame([(1, 1, 0.5)], "k int, pos int, v double")
    with pytest.raises(TypeError):
        running_sum(df, ["k"], "pos", F.col("v"), "s")


def test_small_dimension_shuffles_no_log(spark):
    """A hot key with a dimension below the broadcast threshold: the log stays where it is."""
    log = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    dimension = spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    joined = skewed_join(log, dimension, ["k"], "left")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
