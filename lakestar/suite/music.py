"""Star schema and question tables over the play log."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestar import contracts as c
from lakestar.functions.timeparts import (
    calendar_fields, day_of_week, from_epoch_millis, from_epoch_millis_whole_seconds,
)
from lakestar.operators.lookup import chained_name_join
from lakestar.operators.upsert import from_state
from lakestar.plans import music
from lakestar.plans.load import published, run_question_load
from lakestar.session import work_dir
from lakestar.suite import query
from lakestar.suite.tables import CATALOGUE_SQL, PLAY_LOG_SQL, VISITS_SQL, Tables

STAR_SQL = f"WITH {PLAY_LOG_SQL}, {CATALOGUE_SQL}"
MS = "make_timestamp(ts * 1000)"


@query("songs_dimension", f"""WITH {CATALOGUE_SQL}
SELECT song_id, title, artist_id, year, duration FROM (SELECT *, row_number() OVER (PARTITION BY song_id
    ORDER BY (title IS NULL)::INT + (artist_id IS NULL)::INT + (year IS NULL)::INT + (duration IS NULL)::INT,
             title NULLS FIRST, artist_id NULLS FIRST, year NULLS FIRST, duration NULLS FIRST) AS rn FROM catalogue WHERE song_id IS NOT NULL)
WHERE rn = 1""")
def songs_dimension(t: Tables):
    return music.songs(t.catalogue())


@query("artists_dimension", f"""WITH {CATALOGUE_SQL}
SELECT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,
       artist_longitude AS longitude
FROM (SELECT *, row_number() OVER (PARTITION BY artist_id
                ORDER BY artist_name, artist_location, artist_latitude, artist_longitude) AS rn FROM catalogue)
WHERE rn = 1""")
def artists_dimension(t: Tables):
    return music.artists(t.catalogue())


@query("users_distinct", f"""WITH {PLAY_LOG_SQL}
SELECT DISTINCT user_id, first_name, last_name, gender, level FROM play_log
WHERE page = 'NextSong' AND user_id IS NOT NULL""")
def users_distinct(t: Tables):
    return music.users_distinct(t.play_log(songs=False))


USERS_SQL = f"""WITH {PLAY_LOG_SQL}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id
                  ORDER BY ts, session_id, item_in_session, first_name, last_name, gender) AS f,
              row_number() OVER (PARTITION BY user_id
                  ORDER BY ts DESC, session_id DESC, item_in_session DESC, level DESC) AS l
    FROM play_log WHERE page = 'NextSong')
SELECT a.user_id, a.first_name, a.last_name, a.gender, b.level
FROM ranked a JOIN ranked b ON a.user_id = b.user_id AND a.f = 1 AND b.l = 1"""


@query("users_latest_level", USERS_SQL)
def users_latest_level(t: Tables):
    state = music.user_state(t.play_log(songs=False), ["ts", "session_id", "item_in_session"])
    return from_state(state, ["user_id"], c.USERS.columns)


def _time_sql(ms: str) -> str:
    ts = "make_timestamp(start_ms * 1000)"
    return f"""WITH {PLAY_LOG_SQL}, starts AS (SELECT DISTINCT {ms} AS start_ms FROM play_log WHERE page = 'NextSong')
SELECT start_ms, CAST(hour({ts}) AS INTEGER) AS hour, CAST(day({ts}) AS INTEGER) AS day,
       CAST(week({ts}) AS INTEGER) AS week, CAST(month({ts}) AS INTEGER) AS month,
       CAST(year({ts}) AS INTEGER) AS year, CAST(dayofweek({ts}) + 1 AS INTEGER) AS weekday FROM starts"""


def _time(t: Tables, resolution: str):
    time = music.time_dimension(t.play_log(users=False, songs=False), resolution)
    return time.withColumn("start_ms", F.unix_millis("start_time")).drop("start_time")


@query("time_dimension_millis", _time_sql("ts"))
def time_dimension_millis(t: Tables):
    return _time(t, "millis")


@query("time_dimension_seconds", _time_sql("CAST(ts // 1000 * 1000 AS BIGINT)"))
def time_dimension_seconds(t: Tables):
    return _time(t, "seconds")


@query("calendar_conventions", f"""WITH {VISITS_SQL}
SELECT event_id, ts AS millis, CAST(ts // 1000 AS BIGINT) AS seconds, CAST(hour({MS}) AS INTEGER) AS hour,
       CAST(day({MS}) AS INTEGER) AS day, CAST(week({MS}) AS INTEGER) AS week,
       CAST(month({MS}) AS INTEGER) AS month, CAST(year({MS}) AS INTEGER) AS year,
       CAST(dayofweek({MS}) + 1 AS INTEGER) AS weekday, CAST(dayofweek({MS}) AS INTEGER) AS sunday0,
       CAST(isodow({MS}) - 1 AS INTEGER) AS monday0 FROM visits""")
def calendar_conventions(t: Tables):
    stamped = t.visits().select("event_id", from_epoch_millis(F.col("ts")).alias("at"), "ts")
    cut = from_epoch_millis_whole_seconds(F.col("ts"))
    return stamped.select(
        "event_id", F.unix_millis("at").alias("millis"), F.unix_seconds(cut).alias("seconds"),
        *[field.alias(name) for name, field in calendar_fields(F.col("at")).items()],
        day_of_week(F.col("at"), "sunday0").alias("sunday0"), day_of_week(F.col("at"), "monday0").alias("monday0"),
    )


FACT_COLUMNS = """user_id, level, song_id, artist_id, session_id, location, user_agent,
       CAST(year(make_timestamp(start_us)) AS INTEGER) AS year, CAST(month(make_timestamp(start_us)) AS INTEGER) AS month"""


def _key_sql(*parts: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + "))"


def fact_columns(df):
    return df.withColumn("start_us", F.unix_micros("start_time")).drop("start_time")


@query("songplays_inner_distinct", f"""{STAR_SQL}, facts AS (
    SELECT DISTINCT CAST(ts // 1000 * 1000000 AS BIGINT) AS start_us, user_id, level, song_id, artist_id, session_id,
           location, user_agent
    FROM play_log JOIN catalogue ON song = title AND artist = artist_name AND length = duration
    WHERE page = 'NextSong')
SELECT {_key_sql('session_id', 'start_us', 'user_id', 'level', 'song_id', 'artist_id', 'location', 'user_agent')}
       AS songplay_id, start_us, {FACT_COLUMNS} FROM facts""")
def songplays_inner_distinct(t: Tables):
    return fact_columns(music.songplays(t.play_log(users=False), t.catalogue(), "inner", resolution="seconds", distinct=True))


@query("songplays_left_md5", f"""{STAR_SQL}, facts AS (
    SELECT CAST(ts // 1000 * 1000000 AS BIGINT) AS start_us, user_id, level, song_id, artist_id, session_id,
           item_in_session, location, user_agent
    FROM play_log LEFT JOIN catalogue ON song = title AND artist = artist_name AND length = duration
    WHERE page = 'NextSong')
SELECT {_key_sql('session_id', 'start_us', 'item_in_session', 'song_id', 'user_id')} AS songplay_id, start_us, {FACT_COLUMNS}
FROM facts""")
def songplays_left_md5(t: Tables):
    return fact_columns(music.songplays(t.play_log(users=False), t.catalogue(), "left", resolution="seconds"))


LOOKUP_FACTS_SQL = f"""{STAR_SQL}, lookup AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title, artist_name, duration ORDER BY song_id, artist_id)
                   AS rn FROM catalogue) WHERE rn = 1),
facts AS (
    SELECT ts * 1000 AS start_us, user_id, level, song_id, artist_id, session_id, item_in_session, location, user_agent
    FROM play_log LEFT JOIN lookup ON song = title AND artist = artist_name AND length = duration
    WHERE page = 'NextSong')
SELECT {_key_sql('session_id', 'start_us', 'item_in_session', 'song_id', 'user_id')} AS songplay_id, start_us, {FACT_COLUMNS}
FROM facts"""


@query("songplays_lookup_first", LOOKUP_FACTS_SQL)
def songplays_lookup_first(t: Tables):
    return fact_columns(music.songplays(t.play_log(users=False), t.catalogue(), "left", ambiguous="first"))


@query("songplays_with_time", f"""{STAR_SQL}
SELECT user_id, session_id, song_id, ts AS start_ms, CAST(hour({MS}) AS INTEGER) AS hour,
       CAST(week({MS}) AS INTEGER) AS week, CAST(year({MS}) AS INTEGER) AS year,
       CAST(month({MS}) AS INTEGER) AS month, CAST(dayofweek({MS}) + 1 AS INTEGER) AS weekday
FROM play_log JOIN catalogue ON song = title AND artist = artist_name AND length = duration
WHERE page = 'NextSong'""")
def songplays_with_time(t: Tables):
    facts = music.songplays(t.play_log(users=False), t.catalogue(), "inner")
    return music.with_time(facts).select(
        "user_id", "session_id", "song_id", F.unix_millis("start_time").alias("start_ms"),
        "hour", "week", "year", "month", "weekday",
    )


@query("chained_name_join", f"""{STAR_SQL}, heard AS (
    SELECT song, artist, count(*) AS plays FROM play_log WHERE page = 'NextSong' GROUP BY song, artist),
artists AS (SELECT DISTINCT artist_id, artist_name FROM catalogue)
SELECT s.song_id, a.artist_id, h.plays FROM heard h
JOIN catalogue s ON h.song = s.title JOIN artists a ON a.artist_name = h.artist AND a.artist_id = s.artist_id""")
def chained_name_join_plays(t: Tables):
    # Plays are counted per title and artist name first: the join then works on
    # distinct names instead of multiplying every play by its candidates.
    heard = music.plays(t.play_log(users=False)).groupBy("song", "artist").agg(F.count(F.lit(1)).alias("plays"))
    joined = chained_name_join(heard, music.songs(t.catalogue()), music.artists(t.catalogue()))
    return joined.select("song_id", "artist_id", "plays")


@query("distinct_artists_in_fact", f"""{STAR_SQL}
SELECT DISTINCT artist_id FROM play_log LEFT JOIN catalogue
ON song = title AND artist = artist_name AND length = duration WHERE page = 'NextSong'""")
def distinct_artists_in_fact(t: Tables):
    from lakestar.plans.reports import distinct_artists

    return distinct_artists(music.songplays(t.play_log(users=False), t.catalogue()))


# --- question tables ---------------------------------------------------------


def _last_write_sql(key: str, values: str) -> str:
    order = ", ".join(f"{v.strip()} DESC" for v in ("ts, " + values).split(","))
    return f"""SELECT {key}, {values} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM play_log WHERE artist <> '')
WHERE rn = 1"""


SESSION_ITEM_SQL = _last_write_sql("session_id, item_in_session", "artist, song, length")
USER_SESSION_SQL = _last_write_sql("user_id, session_id, item_in_session", "artist, song, first_name, last_name")
USER_SONG_SQL = _last_write_sql("user_id, song, session_id", "first_name, last_name")


@query("session_item_table", f"WITH {PLAY_LOG_SQL} {SESSION_ITEM_SQL}")
def session_item_table(t: Tables):
    return music.session_item(t.play_log(users=False))


@query("user_session_table", f"WITH {PLAY_LOG_SQL} {USER_SESSION_SQL}")
def user_session_table(t: Tables):
    return music.user_session(t.play_log())


@query("user_song_table", f"WITH {PLAY_LOG_SQL} {USER_SONG_SQL}")
def user_song_table(t: Tables):
    return music.user_song(t.play_log())


def _laid_out(t: Tables, contract: c.Contract):
    """A question table as the load wrote and published it."""
    root = work_dir(t.spark, "questions")
    run_question_load(t.play_log(), root, layouts=(contract,))
    return published(t.spark, root, contract)


@query("song_at_session_item", f"""WITH {PLAY_LOG_SQL}, laid_out AS ({SESSION_ITEM_SQL})
SELECT artist, song, length FROM laid_out ORDER BY session_id, item_in_session LIMIT 1""")
def song_at_session_item(t: Tables):
    # The first place there is, so that it exists at every size.
    table = _laid_out(t, c.SESSION_ITEM)
    place = table.select("session_id", "item_in_session").orderBy("session_id", "item_in_session").first()
    return music.song_at(table, *place)


@query("songs_of_user_session", f"""WITH {PLAY_LOG_SQL}
SELECT item_in_session, artist, song, first_name, last_name FROM ({USER_SESSION_SQL})
WHERE user_id = 899 AND session_id = 0 ORDER BY item_in_session""")
def songs_of_user_session(t: Tables):
    return music.songs_of_session(_laid_out(t, c.USER_SESSION), 899, 0)


@query("listeners_of_song", f"""WITH {PLAY_LOG_SQL}
SELECT DISTINCT user_id, first_name, last_name FROM ({USER_SONG_SQL}) WHERE song = 'small ring'""")
def listeners_of_song(t: Tables):
    return music.listeners(_laid_out(t, c.USER_SONG), "small ring")


@query("listeners_of_title_start", f"""WITH {PLAY_LOG_SQL}
SELECT DISTINCT user_id, first_name, last_name FROM ({USER_SONG_SQL}) WHERE song ILIKE 'SMALL R%'""")
def listeners_of_title_start(t: Tables):
    return music.listeners(music.user_song(t.play_log()), "SMALL R", prefix=True)


@query("listeners_of_literal_start", f"""WITH {PLAY_LOG_SQL}, named AS (SELECT * REPLACE ('100% ' || song AS song) FROM play_log)
SELECT DISTINCT user_id, first_name, last_name FROM named WHERE artist <> '' AND starts_with(lower(song), '100% small')""")
def listeners_of_literal_start(t: Tables):
    # Signs that are wildcards elsewhere stand for themselves; "100 small" would match them as wildcards.
    named = t.play_log().withColumn("song", F.concat(F.lit("100% "), "song"))
    return music.listeners(music.user_song(named), "100% SMALL", prefix=True)


TWICE_SQL = f"""WITH {CATALOGUE_SQL}, twice AS (
    SELECT song_id, title, artist_id, year, duration FROM catalogue
    UNION ALL SELECT song_id, NULL, artist_id, year + 1, duration FROM catalogue)"""


@query("songs_given_twice", f"""{TWICE_SQL}
SELECT song_id, title, artist_id, year, duration FROM twice WHERE title IS NOT NULL""")
def songs_given_twice(t: Tables):
    # A second row per id without a title: the complete one is kept.
    songs = t.catalogue()
    gappy = songs.withColumns({"title": F.lit(None).cast("string"), "year": F.col("year") + 1})
    return music.songs(songs.unionByName(gappy))


@query("event_subset", f"""WITH {PLAY_LOG_SQL}
SELECT artist, first_name, gender, item_in_session, last_name, length, level, location, session_id, song, user_id
FROM play_log WHERE artist <> ''""")
def event_subset(t: Tables):
    return music.event_subset(t.play_log())
