import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakestar.contracts import MUSIC_STAR, SONGS, Contract, conform, create_tables, drop_tables, struct
from lakestar.operators import columns, profile, quality


def test_duplicate_columns(spark):
    df = spark.createDataFrame(
        [(1, "x", "x", 1, None, None, "y"), (2, "y", "y", 2, None, None, "x"), (2, "y", "y", 2, None, None, "x")],
        "id int, a string, b string, id2 int, e string, f string, swapped string",
    )
    assert columns.duplicate_columns(df) == {"b": "a", "id2": "id", "f": "e"}
    assert columns.drop_duplicate_columns(df).columns == ["id", "a", "e", "swapped"]


def test_identical_rows_do_not_fake_equality(spark):
    """Fingerprints of pairwise identical rows cancel; the comparison must still tell columns apart."""
    df = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    assert columns.duplicate_columns(df) == {}


def test_three_equal_columns_and_other_types(spark):
    df = spark.createDataFrame([(1, 1, 1, 1, float("nan"), float("nan"))], "a int, b bigint, c int, d int, n double, m double")
    assert columns.duplicate_columns(df) == {"c": "a", "d": "a", "m": "n"}


def test_map_columns_are_left_alone(spark):
    df = spark.range(2).select("id", F.create_map(F.lit("k"), "id").alias("m"), F.create_map(F.lit("k"), "id").alias("n"))
    assert columns.drop_duplicate_columns(df).columns == ["id", "m", "n"]


def test_merge_and_strip_suffixes(spark):
    left = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "id int, max_x string, name string")
    right = spark.createDataFrame([(1, "c", 5)], "id int, name string, n int")
    merged = columns.merge_with_suffixes(left, right, "id")
    assert merged.columns == ["id", "max_x", "name_x", "name_y", "n"]
    assert rows(merged) == [(1, "a", "p", "c", 5), (2, "b", "q", None, None)]
    assert columns.strip_suffix(merged).columns == ["id", "max", "name", "name_y", "n"]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None), (None, "b")], "k int, v string")
    assert rows(profile.missing_percent(df)) == [("k", 50.0), ("v", 50.0)]
    assert profile.duplicate_count(df, ["k"]).first().duplicates == 2
    assert profile.duplicate_count(df.limit(0), ["k"]).first().duplicates == 0
    report = profile.profile({"t": (df, ["k"])})
    assert rows(report) == [("t", "k", "duplicates", 2.0), ("t", "k", "pct_missing", 50.0), ("t", "v", "pct_missing", 50.0)]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "k int, v string")
    parent = spark.createDataFrame([(1,)], "id int")
    bad = lambda f: f.first().bad
    assert bad(quality.primary_key(df, ["k"], "t")) == 2
    assert [r.bad for r in quality.not_null(df, ["k", "v"], "t").orderBy("detail").collect()] == [1, 1]
    assert bad(quality.references(df, "k", parent, "id", "t")) == 1
    assert bad(quality.not_empty(df, "t")) == 0 and bad(quality.not_empty(df.limit(0), "t")) == 1
    assert bad(quality.row_parity(5, df, "t")) == 1 and bad(quality.row_parity(4, df, "t")) == 0
    with pytest.raises(quality.QualityError, match="primary_key t.k: 2"):
        quality.assert_clean(quality.primary_key(df, ["k"], "t"))
    quality.assert_clean(quality.not_empty(df, "t"))


def test_split_valid_keeps_every_row(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "k int, v int")
    valid, rejected = quality.split_valid(df, [F.col("v") > 0, F.col("k").isNotNull()])
    assert rows(valid) == [(1, 5)] and rows(rejected) == [(2, None), (3, -1)]


def test_conform_and_schema_check(spark):
    contract = Contract("t", struct("a int, b double, c string"), key=("a",), not_null=("b",))
    df = spark.createDataFrame([("7", "x"), ("bad", "2.5")], "a string, b string")
    fixed = conform(df, contract)
    assert fixed.schema.simpleString() == "struct<a:int,b:double,c:string>"
    assert rows(fixed) == [(None, 2.5, None), (7, None, None)]
    schema = {r.detail: r.bad for r in quality.schema_matches(df, contract).collect()}
    assert schema == {"a": 1, "b": 1, "c": 1}
    findings = {(r.check, r.detail): r.bad for r in quality.contract_findings(fixed, contract).collect()}
    assert findings[("primary_key", "a")] == 1 and findings[("not_null", "b")] == 1


def test_catalogue_tables(spark, tmp_path):
    create_tables(spark, MUSIC_STAR, str(tmp_path))
    create_tables(spark, MUSIC_STAR, str(tmp_path))
    assert set(spark.table("songs").columns) == set(SONGS.columns) and spark.table("songs").count() == 0
    drop_tables(spark, MUSIC_STAR)
    assert not spark.catalog.tableExists("songs")


def test_only_doubled_columns_are_compared_and_the_contract_is_kept(spark):
    df = spark.createDataFrame([(1, 2, 2, 2, 2)], "id int, a_x int, a_y int, b int, c int")
    assert columns.duplicate_columns(df, [("a_x", "a_y"), ("b", "c")], keep=["c"]) == {"a_y": "a_x"}
    assert columns.duplicate_columns(df.limit(0)) == {}
