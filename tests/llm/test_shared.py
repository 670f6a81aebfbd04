"""Intermediate tables: what a settled result leaves behind."""

import os
from urllib.parse import urlparse

import pytest

from lakestar.llm.shared import saved, settled


def folder(df):
    return os.path.dirname(urlparse(df.inputFiles()[0]).path)


def test_only_the_result_of_a_settled_table_stays(spark):
    passing = []

    def inner():
        passing.append(saved(spark.range(5), "inner-step"))
        return passing[-1].selectExpr("id + 1 AS id")

    def outer():
        passing.append(settled(spark, inner, "inner-result"))
        passing.append(saved(spark.range(3), "outer-step"))
        return passing[1].join(passing[2], "id")

    before = saved(spark.range(2), "before")
    folders = []

    def watched():
        result = outer()
        folders.extend(folder(t) for t in passing[1:])
        assert all(map(os.path.isdir, folders))
        return result

    result = settled(spark, watched, "outer-result")
    assert sorted(r.id for r in result.collect()) == [1, 2]
    assert os.path.isdir(folder(before)) and os.path.isdir(folder(result))
    assert not any(map(os.path.exists, folders))


def test_tables_of_a_failed_build_stay_and_the_next_scope_is_clean(spark):
    kept = []

    def broken():
        kept.append(saved(spark.range(4), "kept"))
        raise ValueError("no result")

    with pytest.raises(ValueError):
        settled(spark, broken, "never")
    settled(spark, lambda: spark.range(1), "other")
    assert kept[0].count() == 4
