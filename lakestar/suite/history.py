"""Tolerant lookups, histories valid at event time, and sessions over the play log and the events."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.operators.sessions import sessions, streamed_sessions
from lakestar.plans import music
from lakestar.session import work_dir
from lakestar.streaming.incremental import file_stream
from lakestar.suite import query
from lakestar.suite.tables import CATALOGUE_SQL, PLAY_LOG_SQL, Tables

# Titles with a letter left out, doubled or changed, and lengths up to half a second off, by row number.
MISSPELT_SQL = f"""{PLAY_LOG_SQL}, misspelt AS (
    SELECT * REPLACE (
        CASE (session_id + item_in_session) % 5 WHEN 0 THEN substr(song, 1, 2) || substr(song, 4)
             WHEN 1 THEN upper(song) || 's' WHEN 2 THEN '  ' || replace(song, 'e', 'a') WHEN 3 THEN 'x' || substr(song, 2) || 'yy' ELSE song END AS song,
        p_price + (session_id % 7 - 3) * 0.25 AS length)
    FROM (SELECT play_log.*, c.duration AS p_price FROM play_log JOIN (SELECT title, artist_name, min(duration) AS duration FROM catalogue GROUP BY ALL) c
          ON song = c.title AND artist = c.artist_name) WHERE page = 'NextSong')"""


def misspelt(t: Tables):
    prices = t.catalogue().groupBy(F.col("title").alias("song"), F.col("artist_name").alias("artist")).agg(F.min("duration").alias("price"))
    case = (F.col("session_id") + F.col("item_in_session")) % 5
    song = F.col("song")
    changed = (
        F.when(case == 0, F.concat(F.substring(song, 1, 2), F.substring(song, 4, 1000))).when(case == 1, F.concat(F.upper(song), F.lit("s")))
        .when(case == 2, F.concat(F.lit("  "), F.replace(song, F.lit("e"), F.lit("a")))).when(case == 3, F.concat(F.lit("x"), F.substring(song, 2, 1000), F.lit("yy")))
        .otherwise(song))
    log = music.plays(t.play_log(users=False)).join(prices, ["song", "artist"])
    return log.withColumns({"length": F.col("price") + (F.col("session_id") % 7 - 3) * F.lit(0.25), "song": changed}).drop("price")


@query("songplays_tolerant", f"""WITH {CATALOGUE_SQL}, {MISSPELT_SQL},
side AS (SELECT song_id, artist_id, duration, lower(title) || chr(31) || lower(artist_name) AS k FROM catalogue),
keys AS (SELECT DISTINCT song, artist, length, regexp_replace(trim(lower(song)), '\\s+', ' ', 'g') || chr(31) || lower(artist) AS k FROM misspelt),
found AS (
    SELECT song, artist, length, song_id, artist_id FROM keys JOIN side
    ON duration >= length - 0.6 AND duration <= length + 0.6 AND abs(length - duration) <= 0.5 AND levenshtein(keys.k, side.k) <= 2
    QUALIFY row_number() OVER (PARTITION BY song, artist, length
        ORDER BY levenshtein(keys.k, side.k), abs(length - duration), song_id, artist_id) = 1)
SELECT ts, user_id, session_id, item_in_session, song_id, artist_id FROM misspelt LEFT JOIN found USING (song, artist, length)""")
def songplays_tolerant(t: Tables):
    log = misspelt(t)
    facts = music.songplays(log.withColumns({"at": F.col("ts"), "item": F.col("item_in_session")}), t.catalogue(), keep=("at", "item"), tolerance=(2, 0.5))
    return facts.select(F.col("at").alias("ts"), "user_id", "session_id", F.col("item").alias("item_in_session"), "song_id", "artist_id")


LEVELS_SQL = f"""{PLAY_LOG_SQL}, last_of AS (
    SELECT user_id, ts, level FROM play_log WHERE page = 'NextSong'
    QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY session_id DESC, item_in_session DESC) = 1),
changed AS (
    SELECT user_id, level, ts AS valid_from FROM last_of
    QUALIFY lag(level) OVER (PARTITION BY user_id ORDER BY ts) IS DISTINCT FROM level),
history AS (SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS valid_to FROM changed)"""


@query("level_history", f"WITH {LEVELS_SQL} SELECT user_id, level, valid_from, valid_to FROM history")
def level_history(t: Tables):
    return music.level_history(t.play_log(songs=False))


@query("visits_with_level_then", f"""WITH {LEVELS_SQL}
SELECT p.user_id, p.ts, p.session_id, p.item_in_session, p.page, h.level AS level_then FROM play_log p LEFT JOIN history h
ON h.user_id = p.user_id AND h.valid_from <= p.ts AND (h.valid_to IS NULL OR p.ts < h.valid_to) WHERE p.page <> 'NextSong'""")
def visits_with_level_then(t: Tables):
    log = t.play_log(songs=False)
    other = log.where(F.col("page") != music.PLAY_PAGE).select("user_id", "ts", "session_id", "item_in_session", "page")
    return music.with_level_at_event(other, music.level_history(log))


GAP = 1800
SESSIONS_SQL = f"""WITH flagged AS (
    SELECT user_id, epoch_us(ts) AS us, value, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= {GAP} * 1000000 THEN 0 ELSE 1 END AS first
    FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY us) AS n FROM flagged)
SELECT user_id, CAST(min(us) AS BIGINT) AS first_us, CAST(max(us) AS BIGINT) AS last_us, count(*) AS rows FROM numbered GROUP BY user_id, n"""


def _spans(found):
    return found.select("user_id", F.unix_micros("first_at").alias("first_us"), F.unix_micros("last_at").alias("last_us"), "rows")


@query("sessions_by_gap", SESSIONS_SQL)
def sessions_by_gap(t: Tables):
    return _spans(sessions(t.events.select("user_id", F.col("ts").cast("timestamp").alias("at")), ["user_id"], "at", GAP))


@query("streamed_sessions", SESSIONS_SQL)
def sessions_of_a_stream(t: Tables):
    """The same sessions from files that arrive one by one; a last row far ahead closes those still open."""
    source, out = work_dir(t.spark, "visit-files"), work_dir(t.spark, "sessions")
    rows = t.events.select("user_id", F.col("ts").cast("timestamp").alias("at"))
    rows.repartitionByRange(4, "at").write.parquet(source)
    # Files come in any order here, so whatever the log spans may be late.
    late = rows.agg(F.max(F.unix_seconds("at")) - F.min(F.unix_seconds("at"))).first()[0] or 0
    ahead = rows.agg((F.max("at") + F.make_dt_interval(secs=F.lit(late + 4 * GAP))).alias("at"))
    ahead.select(F.lit(-1).cast("long").alias("user_id"), "at").write.mode("append").parquet(source)
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("at", T.TimestampType())])
    found = streamed_sessions(file_stream(t.spark, source, schema, "parquet", max_files=2), ["user_id"], "at", GAP, late + GAP)
    query_ = found.writeStream.format("parquet").option("checkpointLocation", work_dir(t.spark, "commits")).option("path", out).trigger(availableNow=True).start()
    query_.awaitTermination()
    return _spans(t.spark.read.schema(found.schema).parquet(out).where("user_id >= 0"))
