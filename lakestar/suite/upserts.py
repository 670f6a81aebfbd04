"""Upserts: closed line items are the stored table, open ones the incoming batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestar.operators.upsert import last_write_wins, rows_to_insert, upsert
from lakestar.suite import query
from lakestar.suite.tables import Tables

KEY = ["l_orderkey", "l_linenumber"]
VALUES = ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]

SIDES_SQL = """rows AS (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag,
           CAST(epoch_us(l_shipdate) AS BIGINT) AS shipped,
           CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS arrival FROM lineitem),
dated AS (SELECT *, CASE arrival WHEN 1 THEN shipped END AS dated FROM rows)"""


def _sides(t: Tables):
    rows = t.lineitem.select(*KEY, *VALUES, F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("shipped"),
                             "l_linestatus")
    target = rows.filter(F.col("l_linestatus") == "F").select(*KEY, *VALUES)
    incoming = rows.filter(F.col("l_linestatus") != "F").drop("l_linestatus")
    return target, incoming


def _pick_sql(columns: list[str], newest: bool) -> str:
    """Values of the oldest or newest row per key, in the order the upsert states."""
    way = "DESC NULLS LAST" if newest else "ASC NULLS FIRST"
    order = ", ".join(f"{c} {way}" for c in ["arrival", "dated", *columns])
    return f"""SELECT l_orderkey, l_linenumber, {', '.join(columns)} FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM dated) WHERE rn = 1"""


FIRST, LAST = VALUES[:3], VALUES[3:]
MIXED_SQL = f"""WITH {SIDES_SQL}
SELECT a.*, b.l_returnflag FROM ({_pick_sql(FIRST, False)}) a JOIN ({_pick_sql(LAST, True)}) b
ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber"""


@query("insert_or_ignore", f"WITH {SIDES_SQL} {_pick_sql(VALUES, False)}")
def insert_or_ignore(t: Tables):
    return upsert(*_sides(t), KEY, ["shipped"], update=[])


@query("insert_only_new_rows", f"""WITH {SIDES_SQL}
SELECT * FROM ({_pick_sql(VALUES, False).replace('FROM dated', 'FROM dated WHERE arrival = 1')}) n
WHERE NOT EXISTS (SELECT 1 FROM rows r WHERE arrival = 0 AND r.l_orderkey = n.l_orderkey
                  AND r.l_linenumber = n.l_linenumber)""")
def insert_only_new_rows(t: Tables):
    return rows_to_insert(*_sides(t), KEY, ["shipped"])


@query("upsert_named_column", MIXED_SQL)
def upsert_named_column(t: Tables):
    return upsert(*_sides(t), KEY, ["shipped"], update=LAST)


@query("upsert_replayed", MIXED_SQL)
def upsert_replayed(t: Tables):
    target, incoming = _sides(t)
    once = upsert(target, incoming, KEY, ["shipped"], update=LAST)
    return upsert(once, incoming, KEY, ["shipped"], update=LAST)


@query("upsert_keeps_unkeyed_rows", f"""WITH {SIDES_SQL} SELECT * FROM ({_pick_sql(VALUES, False)})
UNION ALL SELECT NULL, l_linenumber, {', '.join(VALUES)} FROM rows WHERE arrival = 0 AND l_linenumber = 1""")
def upsert_keeps_unkeyed_rows(t: Tables):
    # Stored rows without a key part stay; incoming ones cannot be keyed.
    target, incoming = _sides(t)

    def unkeyed(df):
        return df.filter("l_linenumber = 1").withColumn("l_orderkey", F.lit(None).cast(df.schema["l_orderkey"].dataType))

    return upsert(target.unionByName(unkeyed(target)), incoming.unionByName(unkeyed(incoming)), KEY, ["shipped"], update=[])


@query("overwrite_by_primary_key", f"WITH {SIDES_SQL} {_pick_sql(VALUES, True)}")
def overwrite_by_primary_key(t: Tables):
    return upsert(*_sides(t), KEY, ["shipped"], update=None)


@query("last_write_wins", f"""SELECT l_orderkey, l_linenumber, shipped, l_partkey, l_quantity FROM (
    SELECT *, CAST(epoch_us(l_shipdate) AS BIGINT) AS shipped, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""")
def last_write_wins_rows(t: Tables):
    rows = t.lineitem.select(
        *KEY, F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("shipped"), "l_partkey", "l_quantity"
    )
    return last_write_wins(rows, KEY, ["shipped"])
