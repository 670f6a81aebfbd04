"""Music domain: the star schema and the one-table-per-question layouts.

Inputs are the typed staging frames (``contracts.STAGING_EVENTS`` and
``STAGING_SONGS``); every function returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar import contracts as c
from lakestar.functions.keys import hash_key
from lakestar.functions.timeparts import calendar_fields, from_epoch_millis, from_epoch_millis_whole_seconds
from lakestar.operators.asof import as_of_join, interval_history
from lakestar.operators.lookup import natural_key_join
from lakestar.operators.skew import skewed_join
from lakestar.operators.tolerant import tolerant_key_join
from lakestar.operators.upsert import first_write_wins, last_write_wins, to_state

# Fixed value: the page that stands for a played song.
PLAY_PAGE = "NextSong"

NATURAL_KEY = {"song": "title", "artist": "artist_name", "length": "duration"}
USER_FIRST = ["first_name", "last_name", "gender"]
USER_LAST = ["level"]


def plays(events: DataFrame) -> DataFrame:
    """Only song plays; a NULL page is none."""
    return events.filter(F.col("page") == PLAY_PAGE)


def gaps(columns: list[str]) -> Column:
    """How many of the columns are NULL."""
    return sum((F.col(n).isNull().cast("int") for n in columns), F.lit(0))


def most_complete(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: the one with the fewest NULLs, among those the smallest, so that re-runs agree."""
    return first_write_wins(rows.withColumn("__gaps", gaps(rows.columns)), [key], ["__gaps"]).drop("__gaps")


def songs(staging_songs: DataFrame) -> DataFrame:
    """One row per song id; of conflicting rows the most complete."""
    return most_complete(staging_songs.select("song_id", "title", "artist_id", "year", "duration"), "song_id")


def artist_rows(staging_songs: DataFrame) -> DataFrame:
    """The artist of each song."""
    return staging_songs.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    )


def artists(staging_songs: DataFrame) -> DataFrame:
    """One row per artist id; of conflicting rows the most complete."""
    return most_complete(artist_rows(staging_songs), "artist_id")


def known_plays(events: DataFrame) -> DataFrame:
    """Plays of a user with an id; a blank id is none."""
    return plays(events).filter(F.trim(F.col("user_id").cast("string")) != "")


def users_distinct(events: DataFrame) -> DataFrame:
    """Every combination of user attributes seen among plays."""
    return known_plays(events).select(*c.USERS.columns).distinct()


def user_state(events: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Mergeable state of the users table: first seen names, last seen level."""
    return to_state(known_plays(events), ["user_id"], order or ["ts"], USER_FIRST, USER_LAST)


EVENT_ORDER = ["session_id", "item_in_session"]


def level_history(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """One row per change of a user's level: user_id, level, valid_from and valid_to (epoch milliseconds; NULL while it lasts)."""
    return interval_history(known_plays(events), ["user_id"], "ts", "level", EVENT_ORDER, hot_rows)


def with_level_at_event(rows: DataFrame, changes: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Rows ``(user_id, ts, ...)`` with ``level_then``, the level their user had at that moment.

    ``changes`` is a history or any log with user_id, level and a time, ``valid_from`` or ``ts``.
    """
    at = "valid_from" if "valid_from" in changes.columns else "ts"
    tiebreak = [c for c in EVENT_ORDER if c in changes.columns]
    known = changes.where(F.col("level").isNotNull()).withColumnRenamed("level", "level_then")
    return as_of_join(rows, known, ["user_id"], ("ts", at), ["level_then"], tiebreak, hot_rows)


def time_dimension(events: DataFrame, resolution: str = "millis", convention: str = "sunday1") -> DataFrame:
    """One row per start time of a play, with its calendar fields.

    Start times are made distinct before the fields are derived from them.
    """
    distinct = plays(events).select(start_time(resolution).alias("start_time")).filter("start_time IS NOT NULL").distinct()
    return distinct.withColumns(calendar_fields(F.col("start_time"), convention))


def start_time(resolution: str = "millis") -> Column:
    convert = {"millis": from_epoch_millis, "seconds": from_epoch_millis_whole_seconds}[resolution]
    return convert(F.col("ts"))


def songplays(
    events: DataFrame, staging_songs: DataFrame, how: str = "left", ambiguous: str = "all",
    resolution: str = "millis", distinct: bool = False, salt: bool = False, hot_rows: int | None = None,
    keep: tuple[str, ...] = (), tolerance: tuple[int, float] | None = None,
) -> DataFrame:
    """The fact table: plays with the ids of the song and artist they match.

    ``how`` keeps (``left``) or drops (``inner``) plays without a match;
    ``ambiguous="first"`` gives each play at most one match; ``distinct`` collapses
    plays that differ in none of the output columns; ``keep`` names event columns to carry along.
    ``tolerance`` (edits of title and artist together, seconds) gives each play the nearest
    match within it, one at most, whatever ``ambiguous`` says.
    """
    log = plays(events).select(
        start_time(resolution).alias("start_time"), "user_id", "level", "session_id", "item_in_session",
        "location", "user_agent", *NATURAL_KEY, *keep,
    )
    ids = ["song_id", "artist_id"]
    if tolerance is None:
        joined = natural_key_join(log, staging_songs, NATURAL_KEY, ids, how, ambiguous, salt, hot_rows)
    else:
        texts = {"song": NATURAL_KEY["song"], "artist": NATURAL_KEY["artist"]}
        joined = tolerant_key_join(log, staging_songs, texts, ("length", NATURAL_KEY["length"]), ids, *tolerance, how, salt, hot_rows)
    columns = ["start_time", "user_id", "level", *ids, "session_id", "location", "user_agent", *keep]
    if distinct:
        facts = joined.select(*columns).distinct()
        key = hash_key("session_id", F.unix_micros("start_time"), "user_id", "level", "song_id", "artist_id",
                       "location", "user_agent")
    else:
        facts = joined.select(*columns, "item_in_session")
        key = songplay_key()
    return facts.select(
        key.alias("songplay_id"), *columns,
        F.year("start_time").alias("year"), F.month("start_time").alias("month"),
    )


def songplay_key() -> Column:
    """The id of a fact, from its event and its song."""
    return hash_key("session_id", F.unix_micros("start_time"), "item_in_session", "song_id", "user_id")


def with_time(facts: DataFrame, time: DataFrame | None = None) -> DataFrame:
    """Fact rows with their calendar fields.

    The fields are functions of the start time, so without a stored ``time`` table they are
    derived in place. ``time`` is unique per start time, so no row multiplies.
    """
    narrow = facts.drop("year", "month")
    if time is None:
        return narrow.withColumns(calendar_fields(F.col("start_time")))
    return skewed_join(narrow, time, ["start_time"], "left")


# --- one table per question -------------------------------------------------

# The columns kept of an event file, in this order.
EVENT_SUBSET = (
    "artist", "first_name", "gender", "item_in_session", "last_name", "length", "level", "location",
    "session_id", "song", "user_id",
)


def event_subset(events: DataFrame) -> DataFrame:
    """Plays with a known artist, reduced to the columns the question tables need."""
    return events.filter(F.col("artist") != "").select(*EVENT_SUBSET)


def question_table(events: DataFrame, contract: c.Contract, order: list[str]) -> DataFrame:
    """A denormalised table keyed for one question; the last write of a key wins."""
    rows = events.filter(F.col("artist") != "")
    values = [n for n in contract.columns if n not in contract.key]
    keyed = rows.select(*contract.key, *values, *[F.col(o).alias(f"__{i}") for i, o in enumerate(order)])
    latest = last_write_wins(keyed, list(contract.key), [f"__{i}" for i in range(len(order))])
    return latest.select(*contract.columns)


def session_item(events: DataFrame, order: list[str] | None = None) -> DataFrame:
    return question_table(events, c.SESSION_ITEM, order or ["ts"])


def user_session(events: DataFrame, order: list[str] | None = None) -> DataFrame:
    return question_table(events, c.USER_SESSION, order or ["ts"])


def user_song(events: DataFrame, order: list[str] | None = None) -> DataFrame:
    return question_table(events, c.USER_SONG, order or ["ts"])


def song_at(session_items: DataFrame, session_id: int, item: int) -> DataFrame:
    """Artist, song and length heard at one place of a session."""
    here = (F.col("session_id") == session_id) & (F.col("item_in_session") == item)
    return session_items.filter(here).select("artist", "song", "length")


def songs_of_session(user_sessions: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """What a user heard in a session, in listening order."""
    here = (F.col("user_id") == user_id) & (F.col("session_id") == session_id)
    return user_sessions.filter(here).orderBy("item_in_session").select(
        "item_in_session", "artist", "song", "first_name", "last_name"
    )


def listeners(user_songs: DataFrame, song: str, prefix: bool = False) -> DataFrame:
    """Distinct users who heard a song, or any song whose title starts so, in any case."""
    match = F.startswith(F.lower("song"), F.lower(F.lit(song))) if prefix else F.col("song") == song
    return user_songs.filter(match).select("user_id", "first_name", "last_name").distinct()
