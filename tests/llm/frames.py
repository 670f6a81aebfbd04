"""Documents for the tests, beside columns with clashing names."""

import pytest
from pyspark.sql import types as T

from lakestar.llm.shared import prepare

EXTRA = ["n", "score", "size", "start", "text_key", "position", "a.b", "component_id"]


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), beside columns with clashing names."""
    prepare(spark)

    def make(rows, parts=3):
        schema = T.StructType([
            T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()), *(T.StructField(c, T.StringType()) for c in EXTRA)])
        data = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", *("x" for _ in EXTRA)) for r in rows]
        return spark.createDataFrame(data, schema).repartition(parts) if data else spark.createDataFrame([], schema)

    return make
