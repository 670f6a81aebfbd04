import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakestar.functions import cleaning, keys, text, timeparts, weblog


def one(spark, column, ddl="x string", value=None):
    return spark.createDataFrame([(value,)], ddl).select(column.alias("y")).first().y


def test_epoch_forms_differ_below_a_second(spark):
    df = spark.createDataFrame([(1541121934796,), (1541121934001,), (-1500,)], "ms bigint")
    millis = [r[0] for r in df.select(F.unix_millis(timeparts.from_epoch_millis(F.col("ms")))).collect()]
    whole = [r[0] for r in df.select(F.unix_millis(timeparts.from_epoch_millis_whole_seconds(F.col("ms")))).collect()]
    assert millis == [1541121934796, 1541121934001, -1500]
    assert whole == [1541121934000, 1541121934000, -1000]


@pytest.mark.parametrize("day", ["2018-12-31", "2021-01-01", "2020-02-29", "2024-06-02", "2024-06-03", "2024-06-08"])
def test_calendar_fields_follow_iso_weeks_and_three_weekday_conventions(spark, day):
    d = dt.date.fromisoformat(day)
    df = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("timestamp").alias("t"))
    got = df.select(
        *[c.alias(n) for n, c in timeparts.calendar_fields(F.col("t")).items()],
        timeparts.day_of_week(F.col("t"), "sunday0").alias("s0"), timeparts.day_of_week(F.col("t"), "monday0").alias("m0"),
    ).first()
    assert (got.week, got.day, got.month, got.year) == (d.isocalendar()[1], d.day, d.month, d.year)
    assert (got.weekday, got.s0, got.m0) == (d.isoweekday() % 7 + 1, d.isoweekday() % 7, d.weekday())


def test_unknown_weekday_convention():
    with pytest.raises(ValueError):
        timeparts.day_of_week(F.lit(None), "other")


def test_bad_times_become_null(spark):
    assert one(spark, timeparts.parse_time(F.col("x")), value="not a date") is None
    parsed = F.unix_seconds(timeparts.parse_web_log_time(F.col("x")))
    assert one(spark, parsed, value="01/Jul/1995:00:00:01 -0400") == 804571201


def test_year_filter_is_a_range(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2021, 12, 31, 23, 59),), (dt.datetime(2022, 1, 1),), (None,)], "t timestamp")
    df.write.parquet(str(tmp_path / "t"))
    kept = spark.read.parquet(str(tmp_path / "t")).filter(timeparts.in_year(F.col("t"), 2022))
    assert kept.count() == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan


def test_hash_key_keeps_null_parts_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a"), ("a", "a")], "x string, y string")
    got = [r[0] for r in df.select(keys.hash_key("x", "y")).collect()]
    assert None not in got and got[0] == got[1] and len(set(got)) == 3


def test_cleaning(spark):
    assert one(spark, cleaning.money(F.col("x")), value="$1,234.50") == Decimal("1234.50")
    assert one(spark, cleaning.money(F.col("x")), value="free") is None
    assert [one(spark, cleaning.yes_no(F.col("x")), value=v) for v in ("t", "f", "?", None)] == [True, False, None, None]
    assert one(spark, cleaning.nan_to_null(F.col("x")), "x double", float("nan")) is None
    assert one(spark, cleaning.nan_to_null(F.col("x")), "x double", 1.5) == 1.5
    assert [one(spark, cleaning.blank_to_zero(F.col("x")), value=v) for v in ("", "4.87", "n/a")] == [0.0, 4.87, None]
    df = spark.createDataFrame([(None, None, "7")], "a string, b int, c string")
    assert rows(cleaning.cast_columns(cleaning.fill_text(df), {"c": "int"})) == [("", None, 7)]


GOOD = 'in24.inetnebr.com - - [01/Aug/1995:00:00:01 -0400] "GET /shuttle/log.txt HTTP/1.0" 200 1839'
LINES = [
    GOOD,
    'h - - [01/Aug/1995:00:00:07 -0400] "GET /" 304 -',
    'h - - [01/Aug/1995:00:00:07 -0400] "GET /a\u0001b HTTP/1.0" 200 5 trailing',
    "garbage",
    'garbage with\u0001a mark',
    "",
    None,
]


def test_log_lines(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    got = weblog.typed(weblog.parse_lines(df)).collect()
    assert [r.parse_ok for r in got] == [True, True, True, False, False, False, False]
    assert [r.host for r in got] == ["in24.inetnebr.com", "h", "h", None, None, None, None]
    assert [r.endpoint for r in got][:3] == ["/shuttle/log.txt", "/", "/a\u0001b"]
    assert [r.protocol for r in got][:3] == ["HTTP/1.0", "", "HTTP/1.0"]
    assert [r.content_size_bytes for r in got] == [1839, 0, 5, None, None, None, None]
    assert got[0].response_code == 200 and got[0].request_time is not None
    maps = [r[0] for r in df.select(weblog.parse_map(F.col("value"))).collect()]
    assert maps[0]["date_time"] == "01/Aug/1995:00:00:01 -0400" and maps[1]["content_size"] == "0"
    assert maps[3:] == [None, None, None, None]


def test_word_count(spark):
    df = spark.createDataFrame([(" Red  river song",), ("red river song",), (None,)], "t string")
    assert rows(text.word_count(df, F.col("t"))) == [
        ("", 1), ("Red", 1), ("red", 1), ("river", 2), ("song", 2)]
    assert rows(text.word_count(df, F.col("t"), lower=True, keep_empty=False)) == [("red", 2), ("river", 2), ("song", 2)]


def test_tagged_words(spark):
    ddl = "pos array<struct<result string, metadata map<string,string>>>"
    data = [([("NNP", {"word": "Rome"}), ("VB", {"word": "go"}), ("NNPS", {})],), ([],), (None,)]
    df = spark.createDataFrame(data, ddl)
    assert rows(text.tagged_words(df, "pos")) == [(None, "NNPS"), ("Rome", "NNP")]
