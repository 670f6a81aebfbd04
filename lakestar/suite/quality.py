"""Cleaning, profiling and quality checks over the shared tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.contracts import Contract, conform, struct
from lakestar.functions.cleaning import blank_to_zero, cast_columns, fill_text, money, nan_to_null
from lakestar.operators import quality as q
from lakestar.operators.profile import describe_columns, describe_numbers, duplicate_count, missing_percent, profile
from lakestar.suite import query
from lakestar.suite.tables import LABELLED_SQL, Tables


@query("cleaned_values", f"""SELECT c_custkey, CASE WHEN c_acctbal >= 5000 THEN CAST(c_acctbal AS DOUBLE) END AS from_money,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS from_nan,
       CASE WHEN c_nationkey < 10 THEN 0.0 ELSE CAST(c_nationkey AS DOUBLE) END AS from_blank,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS filled,
       CASE WHEN c_acctbal >= 5000 THEN CAST(c_custkey AS INTEGER) END AS from_text FROM customer""")
def cleaned_values(t: Tables):
    rich = F.col("c_acctbal") >= 5000
    dirty = t.customer.select(
        "c_custkey",
        F.when(rich, F.concat(F.lit("$"), F.format_number("c_acctbal", 2))).otherwise("n/a").alias("money_text"),
        F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("nan_number"),
        F.when(F.col("c_nationkey") < 10, "").otherwise(F.col("c_nationkey").cast("string")).alias("blank_text"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("filled"),
        F.when(rich, F.col("c_custkey").cast("string")).otherwise("unknown").alias("from_text"),
    )
    typed = cast_columns(fill_text(dirty, ["filled"]), {"from_text": "int"})
    return typed.select(
        "c_custkey", money(F.col("money_text")).cast("double").alias("from_money"),
        nan_to_null(F.col("nan_number")).alias("from_nan"), blank_to_zero(F.col("blank_text")).alias("from_blank"),
        "filled", "from_text",
    )


@query("complete_rows", f"""WITH {LABELLED_SQL}
SELECT doc_id, source, quality, toxic FROM labelled WHERE lang IS NOT NULL AND source IS NOT NULL
AND text IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""")
def complete_rows(t: Tables):
    return t.labelled().na.drop("any").select("doc_id", "source", "quality", "toxic")


@query("rows_with_quality", f"WITH {LABELLED_SQL} SELECT doc_id, quality FROM labelled WHERE quality IS NOT NULL")
def rows_with_quality(t: Tables):
    return t.labelled().select("doc_id", "quality").dropna("any", subset=["quality"])


def _missing_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 0) AS pct_missing"
        " FROM labelled" for c in columns
    )


LABELLED_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


@query("missing_percent", f"WITH {LABELLED_SQL} {_missing_sql(LABELLED_COLUMNS)}")
def missing_percent_per_column(t: Tables):
    return missing_percent(t.labelled())


@query("duplicate_texts", "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT text FROM documents)) AS BIGINT)"
       " AS duplicates FROM documents")
def duplicate_texts(t: Tables):
    return duplicate_count(t.documents, ["text"])


@query("table_profile", f"""WITH {LABELLED_SQL}, m AS ({_missing_sql(LABELLED_COLUMNS)})
SELECT 'documents' AS "table", "column", 'pct_missing' AS metric, pct_missing AS value FROM m
UNION ALL SELECT 'documents', 'text', 'duplicates', CAST(count(*) - count(DISTINCT text) AS DOUBLE) FROM documents
UNION ALL SELECT 'lineitem', c, 'pct_missing', 0.0 FROM (SELECT unnest(['l_orderkey', 'l_linenumber']) AS c)
UNION ALL SELECT 'lineitem', 'l_orderkey,l_linenumber', 'duplicates', CAST(sum(n - 1) AS DOUBLE)
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def table_profile(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    return profile({"documents": (t.labelled(), ["text"]), "lineitem": (lines, lines.columns)})


@query("describe_numbers", """SELECT 'value' AS "column", count(value) AS count, round(avg(value), 6) AS mean,
       round(stddev(value), 6) AS stddev, min(value) AS min, max(value) AS max FROM events
UNION ALL SELECT 'user_id', count(user_id), round(avg(user_id), 6), round(stddev(user_id), 6),
       CAST(min(user_id) AS DOUBLE), CAST(max(user_id) AS DOUBLE) FROM events""")
def describe_event_numbers(t: Tables):
    stats = describe_numbers(t.events, ["value", "user_id"])
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query("describe_columns", """SELECT 'event_type' AS "column", count(event_type) AS count, CAST(NULL AS DOUBLE) AS mean,
       CAST(NULL AS DOUBLE) AS stddev, min(event_type) AS min, max(event_type) AS max FROM events
UNION ALL SELECT 'user_id', count(user_id), round(avg(user_id), 6), round(stddev(user_id), 6),
       CAST(min(user_id) AS VARCHAR), CAST(max(user_id) AS VARCHAR) FROM events""")
def describe_event_columns(t: Tables):
    stats = describe_columns(t.events, ["event_type", "user_id"])
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query("missing_percent_with_nan", """SELECT 'c_custkey' AS "column", 0.0 AS pct_missing UNION ALL
SELECT 'c_acctbal', round(avg(CASE WHEN c_acctbal < 1000 THEN 1.0 ELSE 0.0 END) * 100, 0) FROM customer UNION ALL
SELECT 'c_mktsegment', round(avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END) * 100, 0) FROM customer""")
def missing_percent_with_nan(t: Tables):
    gappy = t.customer.select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, None).when(F.col("c_acctbal") < 1000, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"))
    return missing_percent(gappy)


VALID_SQL = "(o_totalprice >= 100000 AND o_orderpriority <> '5-LOW')"


@query("split_by_constraints", f"""SELECT o_orderkey, 'valid' AS part FROM orders WHERE coalesce({VALID_SQL}, false)
UNION ALL SELECT o_orderkey, 'rejected' FROM orders WHERE NOT coalesce({VALID_SQL}, false)""")
def split_by_constraints(t: Tables):
    good, bad = q.split_valid(t.orders, [F.col("o_totalprice") >= 100000, F.col("o_orderpriority") != "5-LOW"])
    return good.select("o_orderkey", F.lit("valid").alias("part")).unionByName(bad.select("o_orderkey", F.lit("rejected").alias("part")))


@query("constraint_flags", """SELECT o_orderkey, o_custkey, o_totalprice,
       (o_totalprice >= 100000 AND o_orderpriority <> '5-LOW' AND o_custkey IS NOT NULL) AS valid FROM orders""")
def constraint_flags(t: Tables):
    constraints = [F.col("o_totalprice") >= 100000, F.col("o_orderpriority") != "5-LOW", F.col("o_custkey").isNotNull()]
    return q.flag_valid(t.orders, constraints).select("o_orderkey", "o_custkey", "o_totalprice", "valid")


# Quantity is a double and there is no comment: two things the schema check must report.
LINE_CONTRACT = Contract(
    "lineitem", struct("l_orderkey bigint, l_linenumber int, l_quantity int, l_comment string"),
    key=("l_orderkey", "l_linenumber"), not_null=("l_quantity",),
)


@query("quality_findings", """
SELECT 'not_empty' AS "check", 'orders' AS "table", 'rows' AS detail, CAST(0 AS BIGINT) AS bad
UNION ALL SELECT 'schema', 'lineitem', 'l_orderkey', 0 UNION ALL SELECT 'schema', 'lineitem', 'l_linenumber', 0
UNION ALL SELECT 'schema', 'lineitem', 'l_quantity', 1 UNION ALL SELECT 'schema', 'lineitem', 'l_comment', 1
UNION ALL SELECT 'primary_key', 'lineitem', 'l_orderkey,l_linenumber', CAST(sum(n - 1) AS BIGINT)
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'not_null', 'lineitem', 'l_quantity', count(*) FROM lineitem WHERE l_quantity IS NULL
UNION ALL SELECT 'not_null', 'labelled', 'quality', (SELECT count(*) FROM documents) - (SELECT count(*) FROM labels)
UNION ALL SELECT 'references', 'lineitem', 'l_orderkey->o_orderkey', count(*) FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'references', 'documents', 'doc_id->doc_id', count(*) FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def quality_findings(t: Tables):
    return reduce(
        DataFrame.unionByName,
        [
            q.not_empty(t.orders, "orders"),
            q.contract_findings(t.lineitem, LINE_CONTRACT),
            q.not_null(t.labelled(), ["quality"], "labelled"),
            q.references(t.lineitem, "l_orderkey", t.orders, "o_orderkey", "lineitem"),
            q.references(t.documents, "doc_id", t.labels, "doc_id", "documents"),
        ],
    )


@query("conformed_lines", """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
       CAST(NULL AS VARCHAR) AS l_comment FROM lineitem""")
def conformed_lines(t: Tables):
    return conform(t.lineitem, LINE_CONTRACT)
