"""Every registered query against its reference SQL on the smallest shared tables."""

import pytest

import oracle
from lakestar.suite import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, duck):
    assert name in ORACLES
    assert not oracle.compare(name, QUERIES[name](spark, SF_DIR), duck, ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["mean_rows"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
