"""The music star loaded file by file, as new song and event files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar import contracts as c
from lakestar.functions.timeparts import calendar_fields
from lakestar.operators.lookup import smallest_ids
from lakestar.operators.upsert import FIRST, from_state, merge_states
from lakestar.plans import music
from lakestar.session import freed_shuffles, remove_folder
from lakestar.streaming.incremental import DeltaLog, append_batch, ingest_available, read_batches

# The columns of the songs table lead, as they settle which of two rows is kept.
SONG_VALUES = ("title", "artist_id", "year", "duration", "artist_name", "artist_location", "artist_latitude",
               "artist_longitude")
ARTIST_VALUES = ("name", "location", "latitude", "longitude")
# What the tables need of a play.
HEARD = T.StructType([f for f in c.STAGING_EVENTS.schema if f.name in (
    "ts", "page", "user_id", "first_name", "last_name", "gender", "level", "session_id", "item_in_session", "location", "user_agent", *music.NATURAL_KEY)])
# A stored fact holds what its event is known by; the hash of it, its id, is made when facts are read.
FACTS = T.StructType([*[f for f in c.SONGPLAYS.schema if f.name not in ("songplay_id", "user_id")], *[HEARD[n] for n in ("user_id", "item_in_session")]])


class StarStream:
    """Incremental tables under one root.

    Songs and artists keep their most complete row, start times what was seen first;
    users keep their first names and their latest level. Facts look up the songs known
    when their batch runs. Plays are kept beside them, and a batch of songs looks up the plays of its
    natural keys again, so a song that comes late completes the facts before it, whatever the order of the files.
    Events sent again do not double their facts: of the rows of an event the one with the smallest
    song wins, as in the batch load. A batch leaves its tables only: no shuffle files, cached rows or hashes. Files without rows, and events without plays, leave the tables as they are.
    """

    def __init__(self, root: str, commits: str = "commits"):
        """``commits`` names the folder of the checkpoints; with a new one all files are read again."""
        self.root, self.commits = root, f"{root}/{commits}"
        self.song_log = DeltaLog(f"{root}/songs", ("song_id",), ("gaps",), SONG_VALUES)
        self.artist_log = DeltaLog(f"{root}/artists", ("artist_id",), ("gaps",), ARTIST_VALUES)
        self.user_log = DeltaLog(
            f"{root}/users", ("user_id",), ("ts", "session_id", "item_in_session"),
            tuple(music.USER_FIRST), tuple(music.USER_LAST),
        )
        self.time_log = DeltaLog(f"{root}/time", ("start_time",), (), tuple(c.TIME.columns[1:]))

    def load_songs(self, stream: DataFrame) -> None:
        ingest_available(stream, f"{self.commits}/songs", self._song_batch)

    def load_events(self, stream: DataFrame) -> None:
        ingest_available(stream, f"{self.commits}/events", self._event_batch)

    def _song_batch(self, songs: DataFrame, batch: str) -> None:
        rows = songs.persist()
        try:
            gaps = music.gaps(["song_id", *SONG_VALUES[:4]])
            self.song_log.append(rows.withColumn("gaps", gaps), batch)
            artists = music.artist_rows(rows)
            self.artist_log.append(artists.withColumn("gaps", music.gaps(artists.columns)), batch)
            # Plays look up the natural keys of this batch only; those that meet none have their fact already.
            keys = list(music.NATURAL_KEY.values())
            touched = self.catalogue(songs.sparkSession).join(rows.select(*keys), keys, "left_semi")
            heard = read_batches(songs.sparkSession, f"{self.root}/heard", HEARD)
            self._append_facts(heard, touched, "inner", f"{batch}-songs")
        finally:
            rows.unpersist()

    def _event_batch(self, events: DataFrame, batch: str) -> None:
        # One parse of the batch's files; what follows reads the few columns it needs of the stored plays.
        append_batch(music.plays(events).select(*HEARD.fieldNames()), f"{self.root}/heard", batch, gather=False)
        plays = read_batches(events.sparkSession, f"{self.root}/heard", HEARD, batch)
        starts = plays.select(music.start_time().alias("start_time")).distinct()  # before the fields are derived from them
        self.time_log.append(starts.withColumns(calendar_fields(F.col("start_time"))), batch)
        self.user_log.append(music.known_plays(plays), batch)
        self._append_facts(plays, self.catalogue(events.sparkSession), "left", batch)

    def _append_facts(self, heard: DataFrame, songs: DataFrame, how: str, batch: str) -> None:
        spark, folder = heard.sparkSession, f"{self.root}/lookups/{batch}"
        ids = smallest_ids(songs, list(music.NATURAL_KEY.values()), ["song_id", "artist_id"])
        # As a table their size is known: if it is small Spark broadcasts them, and the plays stay where they are.
        with freed_shuffles(spark):
            ids.write.mode("overwrite").option("compression", "zstd").parquet(folder)
        known = spark.read.schema(ids.schema).parquet(folder)
        facts = music.songplays(heard.withColumn("item", F.col("item_in_session")), known, how, keep=("item",))
        append_batch(facts.withColumnRenamed("item", "item_in_session").select(*FACTS.fieldNames()), f"{self.root}/songplays", batch, c.SONGPLAYS.partition_by)
        remove_folder(spark, folder)

    def catalogue(self, spark: SparkSession) -> DataFrame:
        known = self.song_log.read(spark)
        return known if known is not None else spark.createDataFrame([], c.STAGING_SONGS.schema)

    def songplays(self, spark: SparkSession) -> DataFrame:
        facts = read_batches(spark, f"{self.root}/songplays", FACTS)
        # Blank and NULL users are one event, and an event may lack any part, so rows are packed as states here.
        event = ["session_id", "start_time", "item_in_session", "user"]
        values = ["song_id", "artist_id", "user_id", "level", "location", "user_agent"]
        states = facts.withColumn("user", F.coalesce("user_id", F.lit(""))).select(
            *event, F.struct(F.col("song_id").isNull().alias("missing"), *values).alias(FIRST))
        once = from_state(merge_states(states, event), event, [*event, *values])
        dated = once.withColumns({"songplay_id": music.songplay_key(), "year": F.year("start_time"), "month": F.month("start_time")})
        return c.conform(dated, c.SONGPLAYS)

    def _table(self, spark: SparkSession, log: DeltaLog, contract: c.Contract) -> DataFrame:
        known = log.read(spark)
        return c.conform(known, contract) if known is not None else spark.createDataFrame([], contract.schema)

    def users(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, self.user_log, c.USERS)

    def time(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, self.time_log, c.TIME)

    def songs(self, spark: SparkSession) -> DataFrame:
        return music.songs(self.catalogue(spark))

    def artists(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, self.artist_log, c.ARTISTS)
