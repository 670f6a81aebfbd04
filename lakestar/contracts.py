"""Table contracts: columns, types, keys and references of every table we write."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True, eq=False)
class Contract:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "decimal(12,2)": T.DecimalType(12, 2),
}


def struct(columns: str) -> T.StructType:
    """``"a int, b string"`` as a schema. Unlike the built-in parser it needs no running session."""
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


def _contract(name: str, columns: str, **rules) -> Contract:
    return Contract(name, struct(columns), **rules)


# --- music domain: staging -------------------------------------------------

STAGING_EVENTS = _contract(
    "staging_events",
    "artist string, auth string, first_name string, gender string, item_in_session int, last_name string,"
    " length double, level string, location string, method string, page string, registration double,"
    " session_id bigint, song string, status int, ts bigint, user_agent string, user_id string",
)
STAGING_SONGS = _contract(
    "staging_songs",
    "artist_id string, artist_latitude double, artist_location string, artist_longitude double,"
    " artist_name string, duration double, num_songs int, song_id string, title string, year int",
)

# Where each staging column sits in a raw event record.
EVENT_PATHS = {
    "artist": "artist", "auth": "auth", "first_name": "firstName", "gender": "gender",
    "item_in_session": "itemInSession", "last_name": "lastName", "length": "length", "level": "level",
    "location": "location", "method": "method", "page": "page", "registration": "registration",
    "session_id": "sessionId", "song": "song", "status": "status", "ts": "ts",
    "user_agent": "userAgent", "user_id": "userId",
}

# --- music domain: star ----------------------------------------------------

SONGS = _contract(
    "songs", "song_id string, title string, artist_id string, year int, duration double",
    key=("song_id",), not_null=("title", "artist_id", "duration"), partition_by=("year",),
)
ARTISTS = _contract(
    "artists", "artist_id string, name string, location string, latitude double, longitude double",
    key=("artist_id",), not_null=("name",),
)
USERS = _contract(
    "users", "user_id bigint, first_name string, last_name string, gender string, level string", key=("user_id",),
)
TIME = _contract(
    "time", "start_time timestamp, hour int, day int, week int, month int, year int, weekday int",
    key=("start_time",), partition_by=("year", "month"),
)
SONGPLAYS = _contract(
    "songplays",
    "songplay_id string, start_time timestamp, user_id bigint, level string, song_id string, artist_id string,"
    " session_id bigint, location string, user_agent string, year int, month int",
    key=("songplay_id",), not_null=("start_time", "user_id"),
    references={
        "start_time": ("time", "start_time"), "user_id": ("users", "user_id"),
        "song_id": ("songs", "song_id"), "artist_id": ("artists", "artist_id"),
    },
    partition_by=("year", "month"),
)

# --- music domain: one table per question ----------------------------------

SESSION_ITEM = _contract(
    "session_item", "session_id bigint, item_in_session int, artist string, song string, length double",
    key=("session_id", "item_in_session"),
)
USER_SESSION = _contract(
    "user_session",
    "user_id bigint, session_id bigint, item_in_session int, artist string, song string, first_name string,"
    " last_name string",
    key=("user_id", "session_id", "item_in_session"),
)
USER_SONG = _contract(
    "user_song", "user_id bigint, song string, session_id bigint, first_name string, last_name string",
    key=("user_id", "song", "session_id"),
)

# --- lodging domain --------------------------------------------------------

LISTING = _contract(
    "listing",
    "id bigint, month int, name string, description string, host_id bigint, host_name string, host_since timestamp,"
    " source string, latitude double, longitude double, price decimal(12,2), review_scores_rating double,"
    " reviews_per_month double, room_type string, neighbourhood string",
    key=("id",), not_null=("host_since",), partition_by=("month", "room_type"),
)
CALENDAR = _contract(
    "calendar",
    "listing_id bigint, month int, date timestamp, available boolean, adjusted_price decimal(12,2),"
    " minimum_nights int, maximum_nights int",
    key=("listing_id", "date"), not_null=("available",), partition_by=("month",),
)
NEIGHBOURHOODS = _contract(
    "neighbourhoods", "neighbourhood_group string, neighbourhood string",
    key=("neighbourhood",), not_null=("neighbourhood_group",), partition_by=("neighbourhood_group",),
)
REVIEWS = _contract(
    "reviews",
    "listing_id bigint, review_id bigint, review_date timestamp, reviewer_id bigint, reviewer_name string,"
    " comments string, month int",
    key=("review_id",), not_null=("comments",), partition_by=("month",),
)
BOOKINGS = _contract(
    "bookings",
    "id bigint, month_review int, name string, description string, host_id bigint, host_name string,"
    " host_since timestamp, source string, latitude double, longitude double, adjusted_price decimal(12,2),"
    " review_id bigint, review_date timestamp, reviewer_id bigint, review_scores_rating double,"
    " reviews_per_month double, room_type string",
    partition_by=("month_review",),
)

PAYMENTS = _contract(
    "payments",
    "payment_id int, customer_id int, staff_id int, rental_id int, amount double, payment_date date",
    key=("payment_id",),
)

# Parents before children, the order in which the star is created.
MUSIC_STAR = (USERS, SONGS, ARTISTS, TIME, SONGPLAYS)
LODGING_STAR = (LISTING, CALENDAR, NEIGHBOURHOODS, REVIEWS, BOOKINGS)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Exactly the contract's columns and types: absent ones and bad values become NULL."""
    present = set(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}

    def column(f: T.StructField):
        if f.name not in present:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if types[f.name] == f.dataType:
            return F.col(f.name)
        return F.col(f.name).try_cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in contract.schema.fields])


def create_tables(spark: SparkSession, contracts: Iterable[Contract], location: str | None = None) -> None:
    """Empty parquet catalogue tables for the contracts, where they do not exist yet."""
    for c in contracts:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in c.schema.fields)
        parts = f" PARTITIONED BY ({', '.join(c.partition_by)})" if c.partition_by else ""
        place = f" LOCATION '{location}/{c.name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {c.name} ({columns}) USING parquet{parts}{place}")


def drop_tables(spark: SparkSession, contracts: Iterable[Contract]) -> None:
    """Children before parents."""
    for c in reversed(list(contracts)):
        spark.sql(f"DROP TABLE IF EXISTS {c.name}")
