"""The shared tables seen as the music and the lodging domain.

Each stand-in exists twice: as a DataFrame over the whole table and as the SQL
text (``*_SQL``) that reference queries use as a common table expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.functions.weblog import FIELDS, LINE_PATTERN

MARKS = {"view": "NextSong", "signup": "Home", "error": "Submit Downgrade"}

VISITS_SQL = """visits AS (
    SELECT event_id, user_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts, CAST(epoch_us(ts) AS BIGINT) AS ts_us, value,
           CASE event_type WHEN 'view' THEN 'NextSong' WHEN 'signup' THEN 'Home'
                           WHEN 'error' THEN 'Submit Downgrade' ELSE event_type END AS page,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id
    FROM events)"""

PLAY_LOG_SQL = """play_log AS (
    SELECT CAST(epoch_ms(l_shipdate) + l_linenumber * 250 AS BIGINT) AS ts, o_custkey AS user_id,
           c_mktsegment AS first_name, c_name AS last_name, CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'M' END AS gender,
           o_orderstatus AS level, l_orderkey AS session_id, l_linenumber AS item_in_session,
           p_brand AS artist, p_name AS song, p_retailprice * (1 - l_discount) AS length,
           o_orderpriority AS location, l_linestatus AS user_agent,
           CASE l_returnflag WHEN 'N' THEN 'NextSong' WHEN 'A' THEN 'Home' ELSE 'Submit Downgrade' END AS page
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
                  JOIN part ON l_partkey = p_partkey)"""

CATALOGUE_SQL = """catalogue AS (
    SELECT 'S' || p_partkey AS song_id, p_name AS title, p_brand || '/' || p_type AS artist_id,
           p_brand AS artist_name, p_type AS artist_location, CAST(p_size AS DOUBLE) AS artist_latitude,
           CAST(NULL AS DOUBLE) AS artist_longitude, p_retailprice AS duration, 1 AS num_songs, p_size AS year
    FROM part)"""

def _field_sql(group: int, name: str) -> str:
    value = f"regexp_extract(value, '{LINE_PATTERN}', {group})"
    if name == "content_size":
        value = f"CASE WHEN {value} = '-' THEN '0' ELSE {value} END"
    return f"CASE WHEN parse_ok THEN {value} END AS {name}"


WEB_LOG_SQL = f"""web_log AS (
    SELECT event_id, CASE WHEN value > 60 THEN 'corrupt ' || event_id ELSE
           'u' || user_id || '.example.net - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET /' ||
           event_type || '/' || json_extract_string(props, '$.k') || ' HTTP/1.0" 200 ' ||
           CASE WHEN event_type = 'error' THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END
           END AS value
    FROM events),
matched AS (SELECT event_id, value, regexp_matches(value, '{LINE_PATTERN}') AS parse_ok FROM web_log),
parsed AS (SELECT event_id, parse_ok, {", ".join(_field_sql(i, n) for i, n in enumerate(FIELDS, 1))} FROM matched)"""

LABELLED_SQL = """labelled AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


class Tables:
    """Lazy access to the shared tables and to the stand-ins built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def visits(self) -> DataFrame:
        """``events`` as a page log, epoch milliseconds as time."""
        page: Column = F.col("event_type")
        for event_type, mark in MARKS.items():
            page = F.when(F.col("event_type") == event_type, mark).otherwise(page)
        utc = F.col("ts").cast("timestamp")
        return self.events.select(
            "event_id", "user_id", F.unix_millis(utc).alias("ts"), F.unix_micros(utc).alias("ts_us"), "value",
            page.alias("page"), F.to_date("ts").cast("string").alias("session_id"),
        )

    def play_log(self, users: bool = True, songs: bool = True) -> DataFrame:
        """Line items as a song-play log; the user or song columns only if asked for.

        A line without its customer or part is no play either way.
        """
        known_user, known_song = F.col("o_custkey") == F.col("c_custkey"), F.col("l_partkey") == F.col("p_partkey")
        # Lines meet the few columns of their part, and orders their customer, before the two meet: less moves.
        line = self.lineitem.join(self.part, known_song) if songs else self.lineitem.join(self.part.select("p_partkey"), known_song, "left_semi")
        order = self.orders.join(self.customer, known_user) if users else self.orders.join(self.customer.select("c_custkey"), known_user, "left_semi")
        log = line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        flag = F.col("l_returnflag")
        columns = [
            (F.unix_millis(F.col("l_shipdate").cast("timestamp")) + F.col("l_linenumber") * 250).alias("ts"),
            F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("level"),
            F.col("l_orderkey").alias("session_id"), F.col("l_linenumber").alias("item_in_session"),
            F.col("o_orderpriority").alias("location"), F.col("l_linestatus").alias("user_agent"),
            F.when(flag == "N", "NextSong").when(flag == "A", "Home").otherwise("Submit Downgrade").alias("page"),
        ]
        if users:
            columns += [
                F.col("c_mktsegment").alias("first_name"), F.col("c_name").alias("last_name"),
                F.when(F.col("c_acctbal") < 0, "F").otherwise("M").alias("gender"),
            ]
        if songs:
            columns += [
                F.col("p_brand").alias("artist"), F.col("p_name").alias("song"),
                (F.col("p_retailprice") * (1 - F.col("l_discount"))).alias("length"),
            ]
        return log.select(*columns)

    def catalogue(self) -> DataFrame:
        """Parts as songs: an artist name has several artist ids."""
        return self.part.select(
            F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("song_id"), F.col("p_name").alias("title"),
            F.concat_ws("/", "p_brand", "p_type").alias("artist_id"), F.col("p_brand").alias("artist_name"),
            F.col("p_type").alias("artist_location"), F.col("p_size").cast("double").alias("artist_latitude"),
            F.lit(None).cast("double").alias("artist_longitude"), F.col("p_retailprice").alias("duration"),
            F.lit(1).alias("num_songs"), F.col("p_size").alias("year"),
        )

    def web_log(self) -> DataFrame:
        """``events`` written out as access-log lines, some of them corrupt."""
        size = F.when(F.col("event_type") == "error", "-").otherwise(
            F.floor(F.col("value") * 100).cast("bigint").cast("string")
        )
        line = F.concat(
            F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.net - - ["),
            F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET /'), F.col("event_type"), F.lit("/"),
            F.get_json_object("props", "$.k"), F.lit(' HTTP/1.0" 200 '), size,
        )
        corrupt = F.concat(F.lit("corrupt "), F.col("event_id").cast("string"))
        return self.events.select("event_id", F.when(F.col("value") > 60, corrupt).otherwise(line).alias("value"))

    def labelled(self) -> DataFrame:
        """Documents with their labels, where they have any."""
        return self.documents.join(self.labels, "doc_id", "left")
