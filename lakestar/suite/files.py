"""Sources, sinks and incremental loads: shared tables written out raw and read back."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.contracts import PAYMENTS, SONGPLAYS, STAGING_EVENTS, STAGING_SONGS, Contract, conform, create_tables, struct
from lakestar.operators import quality as q
from lakestar.plans import music
from lakestar.plans.load import published, run_load, run_lodging_load
from lakestar.plans.reports import revenue_per_month
from lakestar.session import freed_shuffles, remove_folder, work_dir
from lakestar.sources import files, sinks
from lakestar.streaming.incremental import DeltaLog, append_batch, file_stream, ingest_available, read_batches
from lakestar.streaming.star import StarStream
from lakestar.suite import query
from lakestar.suite.lodging import CALENDAR_SQL, LISTING_SQL, REVIEWS_SQL, calendar_file, listing_files, places, review_file
from lakestar.suite.music import LOOKUP_FACTS_SQL, USERS_SQL, fact_columns
from lakestar.suite.tables import CATALOGUE_SQL, PLAY_LOG_SQL, Tables


# --- JSON --------------------------------------------------------------------

EVENT_SQL = "SELECT event_id, user_id, event_type, value FROM events"
EVENT_SCHEMA = struct("event_id bigint, user_id bigint, event_type string, value double")


def _event_json(t: Tables, nested: bool = False) -> str:
    """``events`` as JSON lines in a tree of folders, one per event type."""
    root = work_dir(t.spark, "json")
    rows = t.events.select("event_id", "user_id", "value", F.col("event_type").alias("kind"), "event_type")
    if nested:
        rows = rows.select("kind", F.struct("event_id", "value").alias("data"),
                           F.struct(F.col("user_id").alias("userId"), F.col("event_type").alias("page")).alias("who"))
    rows.write.partitionBy("kind").json(root)
    return root


@query("json_with_declared_schema", EVENT_SQL)
def json_with_declared_schema(t: Tables):
    return files.read_json(t.spark, _event_json(t), EVENT_SCHEMA, tree=True, glob="*.json")


@query("json_with_inferred_schema", EVENT_SQL)
def json_with_inferred_schema(t: Tables):
    return files.read_json(t.spark, f"{_event_json(t)}/*/*.json")


@query("json_with_absent_field", "SELECT event_id, CAST(NULL AS VARCHAR) AS artist FROM events")
def json_with_absent_field(t: Tables):
    return files.read_json(t.spark, _event_json(t), struct("event_id bigint, artist string"), tree=True)


@query("json_by_field_paths", EVENT_SQL)
def json_by_field_paths(t: Tables):
    paths = {"event_id": "data.event_id", "user_id": "who.userId", "event_type": "who.page", "value": "data.value"}
    return files.read_json_paths(t.spark, _event_json(t, nested=True), paths, Contract("events", EVENT_SCHEMA), tree=True)


# --- CSV and text --------------------------------------------------------------


@query("csv_with_free_text", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_with_free_text(t: Tables):
    root = work_dir(t.spark, "csv")
    sinks.write_csv(t.documents, root, quote_all=True)
    return files.read_csv(t.spark, root, t.documents.schema, multi_line=True)


@query("csv_with_inferred_types", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def csv_with_inferred_types(t: Tables):
    root = work_dir(t.spark, "csv")
    sinks.write_csv(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"), root, sep=";")
    # Whole numbers infer as int, the type of the order key depends on its range.
    read = files.read_csv(t.spark, root, sep=";", infer=True)
    return read.withColumn("l_orderkey", F.col("l_orderkey").cast("bigint"))


@query("csv_headerless", "SELECT CAST(n_nationkey AS VARCHAR) AS _c0, n_name AS _c1 FROM nation")
def csv_headerless(t: Tables):
    root = work_dir(t.spark, "csv")
    sinks.write_csv(t.nation.select("n_nationkey", "n_name"), root, header=False)
    return files.read_csv(t.spark, root, header=False)


@query("csv_tree_union", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def csv_tree_union(t: Tables):
    root = work_dir(t.spark, "csv")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                           F.col("o_orderpriority").alias("folder"))
    rows.write.partitionBy("folder").option("header", True).csv(root)
    schema = struct("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")
    return files.read_csv(t.spark, root, schema, tree=True, glob="*.csv")


@query("event_subset_csv", f"""WITH {PLAY_LOG_SQL}
SELECT artist, first_name, gender, item_in_session, last_name, length, level, location, session_id, song, user_id
FROM play_log WHERE artist <> ''""")
def event_subset_csv(t: Tables):
    root = work_dir(t.spark, "csv")
    subset = music.event_subset(t.play_log())
    sinks.write_csv(subset, root, quote_all=True)
    return files.read_csv(t.spark, root, subset.schema)


@query("revenue_from_payment_files", """SELECT CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1""")
def revenue_from_payment_files(t: Tables):
    root = work_dir(t.spark, "csv")
    payments = t.orders.select(
        F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("customer_id"), F.lit(1).alias("staff_id"),
        F.col("o_orderkey").alias("rental_id"), F.col("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("payment_date"),
    )
    sinks.write_csv(payments, root, sep=";")
    read = files.read_csv(t.spark, root, PAYMENTS.schema, sep=";")
    return revenue_per_month(read).withColumn("revenue", F.col("revenue").cast("double"))


@query("gzip_text_lines", "SELECT url AS value FROM pages")
def gzip_text_lines(t: Tables):
    root = work_dir(t.spark, "text")
    t.pages.select("url").write.option("compression", "gzip").text(root)
    return files.read_text(t.spark, root, partitions=t.spark.sparkContext.defaultParallelism)


# --- parquet tables --------------------------------------------------------------

ORDERS = Contract(
    "orders_by_month", struct("o_orderkey bigint, o_custkey bigint, o_totalprice double, year int, month int"),
    key=("o_custkey", "o_orderkey"), partition_by=("year", "month"),
)
ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month FROM orders"""


def _orders(t: Tables):
    return t.orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})


@query("partitioned_table", ORDERS_SQL)
def partitioned_table(t: Tables):
    root = work_dir(t.spark, "table")
    sinks.write_table(_orders(t), ORDERS, root)
    return files.read_table(t.spark, root, ORDERS)


@query("clustered_table", ORDERS_SQL)
def clustered_table(t: Tables):
    root = work_dir(t.spark, "table")
    sinks.write_clustered(_orders(t), ORDERS, root)
    return files.read_table(t.spark, root, ORDERS)


PLACES = Contract("customers_by_segment", struct("c_custkey bigint, segment string"), key=("c_custkey",), partition_by=("segment",))


@query("blank_partition_values", """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment = 'MACHINERY' THEN NULL
       WHEN c_mktsegment = 'FURNITURE' THEN chr(92) || 'odd' ELSE c_mktsegment END AS segment FROM customer""")
def blank_partition_values(t: Tables):
    root = work_dir(t.spark, "table")
    segment = F.col("c_mktsegment")
    rows = t.customer.select("c_custkey", F.when(segment == "BUILDING", "").when(segment == "MACHINERY", None).when(
        segment == "FURNITURE", "\\odd").otherwise(segment).alias("segment"))
    sinks.write_table(rows, PLACES, root)
    return files.read_table(t.spark, root, PLACES)


@query("created_table", f"""{ORDERS_SQL}""")
def created_table(t: Tables):
    """A catalogue table made from its contract, filled and read by name, and a view over it."""
    name = f"orders_{uuid.uuid4().hex}"
    made = replace(ORDERS, name=name)
    create_tables(t.spark, [made], work_dir(t.spark, "catalogue"))
    conform(_orders(t), made).write.insertInto(name)
    sinks.register_views({f"{name}_view": t.spark.table(name)})
    return t.spark.sql(f"SELECT o_orderkey, o_custkey, o_totalprice, year, month FROM {name}_view")


@query("staged_appends", f"{ORDERS_SQL} WHERE o_orderstatus = 'O' UNION ALL {ORDERS_SQL} WHERE o_orderstatus <> 'O'")
def staged_appends(t: Tables):
    root = work_dir(t.spark, "staging")
    is_open = F.col("o_orderstatus") == "O"
    files.stage(_orders(t).filter(is_open), ORDERS, root)
    return files.stage(_orders(t).filter(~is_open), ORDERS, root, mode="append")


@query("row_parity_after_write", """SELECT 'row_parity' AS "check", 'orders' AS "table", 'rows' AS detail,
       CAST(0 AS BIGINT) AS bad""")
def row_parity_after_write(t: Tables):
    root = work_dir(t.spark, "table")
    written = sinks.write_table(_orders(t), ORDERS, root)
    return q.row_parity(written, files.read_table(t.spark, root, ORDERS), "orders")


# --- incremental -----------------------------------------------------------------

VISIT_SCHEMA = struct("event_id bigint, user_id bigint, ts_us bigint, event_type string, value double")


def _visit_files(t: Tables) -> str:
    """``events`` as JSON files, several per folder, in no useful order."""
    root = work_dir(t.spark, "incoming")
    rows = t.events.select(
        "event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_type", "value",
        F.col("event_type").alias("kind"),
    )
    rows.write.partitionBy("kind").json(root)
    return root


@query("streamed_upsert", """SELECT a.user_id, a.value, b.event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) a JOIN (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) b
ON a.user_id = b.user_id AND a.rn = 1 AND b.rn = 1""")
def streamed_upsert(t: Tables):
    log = DeltaLog(work_dir(t.spark, "users"), ("user_id",), ("ts_us", "event_id"), ("value",), ("event_type",))
    stream = file_stream(t.spark, _visit_files(t), VISIT_SCHEMA, max_files=2)
    checkpoint = work_dir(t.spark, "commits")
    ingest_available(stream, checkpoint, log.append)
    ingest_available(stream, checkpoint, log.append)  # finds nothing new
    ingest_available(stream, work_dir(t.spark, "commits"), log.append)  # all files again, under names of their own
    log.fold(t.spark)
    return log.read(t.spark)


@query("streamed_facts", "SELECT event_id, user_id, event_type, value FROM events")
def streamed_facts(t: Tables):
    root = work_dir(t.spark, "facts")
    stream = file_stream(t.spark, _visit_files(t), VISIT_SCHEMA, max_files=3).drop("ts_us")
    ingest_available(stream, work_dir(t.spark, "commits"), lambda rows, batch: append_batch(rows, root, batch))
    return read_batches(t.spark, root)


# Rows of a gzip file at most, as a single task reads it.
FILE_ROWS = 1_000_000


def _arrivals(rows: DataFrame, key: str, slices: int, batches: int, label: str) -> tuple[str, int]:
    """Rows as gzip JSON files of bounded length, and how many files make one of so many batches.

    They are written a slice of the key at a time, so that what the rows are joined from is shuffled in slices too.
    """
    spark, root = rows.sparkSession, work_dir(rows.sparkSession, label)
    with freed_shuffles(spark):
        for i in range(slices):
            part = rows.where(F.pmod(F.xxhash64(key), F.lit(slices)) == i)
            part.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).json(root)
    return root, max(1, -(-len(spark.read.text(root).inputFiles()) // batches))


@query("streamed_star_facts", LOOKUP_FACTS_SQL)
def streamed_star_facts(t: Tables):
    songs, song_files = _arrivals(t.catalogue(), "song_id", 2, 2, "song-files")
    events, event_files = _arrivals(conform(t.play_log(), STAGING_EVENTS), "session_id", 4, 2, "event-files")
    root = work_dir(t.spark, "star")
    star = StarStream(root)
    star.load_events(file_stream(t.spark, events, STAGING_EVENTS.schema, max_files=event_files))  # before any song
    star.load_songs(file_stream(t.spark, songs, STAGING_SONGS.schema, max_files=song_files))
    # The same files again under a second checkpoint: every fact once, now with its song.
    StarStream(root, "second").load_events(file_stream(t.spark, events, STAGING_EVENTS.schema, max_files=event_files))
    remove_folder(t.spark, events)  # the facts are read from the star's own tables
    return fact_columns(star.songplays(t.spark))


@query("streamed_star_late_songs", LOOKUP_FACTS_SQL)
def streamed_star_late_songs(t: Tables):
    songs, song_files = _arrivals(t.catalogue(), "song_id", 2, 2, "song-files")
    events, event_files = _arrivals(conform(t.play_log(), STAGING_EVENTS), "session_id", 4, 1, "event-files")
    star = StarStream(work_dir(t.spark, "star"))
    star.load_events(file_stream(t.spark, events, STAGING_EVENTS.schema, max_files=event_files))  # before any song, and only once
    remove_folder(t.spark, events)
    star.load_songs(file_stream(t.spark, songs, STAGING_SONGS.schema, max_files=song_files))
    return fact_columns(star.songplays(t.spark))


@query("lodging_load_row_counts", f"""WITH {LISTING_SQL}, {CALENDAR_SQL}, {REVIEWS_SQL}
SELECT 'listing' AS "table", count(*) AS rows FROM listing UNION ALL SELECT 'calendar', count(*) FROM calendar
UNION ALL SELECT 'reviews', count(*) FROM reviews UNION ALL SELECT 'neighbourhoods', count(*) FROM nation
UNION ALL SELECT 'bookings', count(*) FROM calendar c LEFT JOIN reviews r ON r.listing_id = c.listing_id""")
def lodging_load_row_counts(t: Tables):
    detailed, summary = listing_files(t)
    loaded = run_lodging_load(detailed, summary, calendar_file(t), places(t), review_file(t), work_dir(t.spark, "lodging"), strict=False)
    return _row_counts(loaded, ("listing", "calendar", "reviews", "neighbourhoods", "bookings"))


@query("full_load_row_counts", f"""WITH {PLAY_LOG_SQL}, {CATALOGUE_SQL}
SELECT 'songplays' AS "table", count(*) AS rows FROM play_log WHERE page = 'NextSong'
UNION ALL SELECT 'users', count(DISTINCT user_id) FROM play_log WHERE page = 'NextSong'
UNION ALL SELECT 'time', count(DISTINCT ts) FROM play_log WHERE page = 'NextSong'
UNION ALL SELECT 'songs', count(DISTINCT song_id) FROM catalogue
UNION ALL SELECT 'artists', count(DISTINCT artist_id) FROM catalogue""")
def full_load_row_counts(t: Tables):
    loaded = run_load(t.play_log(), t.catalogue(), work_dir(t.spark, "star"), strict=False)
    return _row_counts(loaded, ("songplays", "users", "time", "songs", "artists"))


def _row_counts(tables: dict[str, DataFrame], names: tuple[str, ...]) -> DataFrame:
    counts = [
        tables[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


@query("full_load_songplays", LOOKUP_FACTS_SQL)
def full_load_songplays(t: Tables):
    root = work_dir(t.spark, "star")
    run_load(t.play_log(), t.catalogue(), root, strict=False)
    return fact_columns(published(t.spark, root, SONGPLAYS))


@query("full_load_users", USERS_SQL)
def full_load_users(t: Tables):
    return run_load(t.play_log(), t.catalogue(), work_dir(t.spark, "star"), strict=False)["users"]


@query("full_load_findings", f"""WITH {PLAY_LOG_SQL}, keys AS (
    SELECT count(*) AS n FROM play_log p LEFT JOIN (SELECT title, artist_name, duration, min('S' || p_partkey) AS song_id
           FROM (SELECT p_partkey, p_name AS title, p_brand AS artist_name, p_retailprice AS duration FROM part)
           GROUP BY 1, 2, 3) s ON p.song = s.title AND p.artist = s.artist_name AND p.length = s.duration
    WHERE page = 'NextSong' GROUP BY session_id, ts, item_in_session, song_id)
SELECT "check", "table", detail, bad FROM (
    SELECT 'primary_key' AS "check", 'songplays' AS "table", 'songplay_id' AS detail,
           CAST(sum(n - 1) AS BIGINT) AS bad FROM keys) WHERE bad > 0""")
def full_load_findings(t: Tables):
    findings = run_load(t.play_log(), t.catalogue(), work_dir(t.spark, "star"), strict=False)["findings"]
    return findings.filter(F.col("bad") > 0)
