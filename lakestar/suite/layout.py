"""Lookups by several keys of one laid-out table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.operators.layout import lookup, write_laid_out
from lakestar.plans import music
from lakestar.session import work_dir
from lakestar.suite import query
from lakestar.suite.tables import PLAY_LOG_SQL, Tables

COLUMNS = ["user_id", "session_id", "item_in_session", "artist", "song", "ts"]


@query("plays_by_any_key", f"""WITH {PLAY_LOG_SQL},
plays AS (SELECT {", ".join(COLUMNS)} FROM play_log WHERE page = 'NextSong'),
asked AS (SELECT min(user_id) AS u, max(session_id) AS s, min(song) AS g, arg_max(user_id, session_id) AS su FROM plays)
SELECT 'user' AS asked, plays.* FROM plays JOIN asked ON user_id = u
UNION ALL SELECT 'session', plays.* FROM plays JOIN asked ON session_id = s
UNION ALL SELECT 'song', plays.* FROM plays JOIN asked ON song = g
UNION ALL SELECT 'user and session', plays.* FROM plays JOIN asked ON session_id = s AND user_id = su
UNION ALL SELECT 'nobody', plays.* FROM plays WHERE user_id = -1""")
def plays_by_any_key(t: Tables):
    """Plays found by user, session, song and pairs of them, each from the files that may hold them."""
    plays = music.plays(t.play_log()).select(*COLUMNS)
    path = work_dir(t.spark, "plays-laid-out")
    write_laid_out(plays, path, ["user_id", "session_id", "song"])
    least = plays.agg(
        F.min("user_id").alias("u"), F.max("session_id").alias("s"), F.min("song").alias("g"), F.max_by("user_id", "session_id").alias("su")).first()
    asked = {
        "user": {"user_id": least.u}, "session": {"session_id": least.s}, "song": {"song": least.g},
        "user and session": {"user_id": least.su, "session_id": least.s}, "nobody": {"user_id": -1}}
    return reduce(DataFrame.unionByName, [lookup(t.spark, path, equals).select(F.lit(name).alias("asked"), *COLUMNS) for name, equals in asked.items()])
