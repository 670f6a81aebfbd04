"""The named reports. Each takes frames and returns a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.functions.text import tagged_words, word_count
from lakestar.functions.timeparts import from_epoch_millis, in_year
from lakestar.functions.weblog import parse_lines, typed
from lakestar.operators.lookup import never_seen, rows_at_maximum, top_k
from lakestar.operators.running import label_by_anchor
from lakestar.operators.skew import fanout_join, hot_grid, skewed_join

PLAY_PAGE, DOWNGRADE_PAGE = "NextSong", "Submit Downgrade"


def pages_not_visited(log: DataFrame, user_id: str = "") -> DataFrame:
    """Pages that exist in the log but that the given user never opened."""
    return never_seen(log.select("page"), log.filter(F.col("user_id") == user_id).select("page"))


def pages_not_visited_sql(log: DataFrame, user_id: str = "") -> DataFrame:
    """The same question in SQL, as an anti-join."""
    return log.sparkSession.sql(
        """
        WITH pages AS (SELECT DISTINCT page FROM {log}),
             seen AS (SELECT DISTINCT page FROM {log} WHERE user_id = :user_id)
        SELECT page FROM pages WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.page <=> pages.page)
        """,
        args={"user_id": user_id}, log=log,
    )


def count_users(log: DataFrame, gender: str = "F") -> DataFrame:
    """Users of a gender, counted two ways: a NULL id is no user to the first, one user to the second."""
    rows = log.filter(F.col("gender") == gender).select("user_id").distinct()
    return rows.agg(F.count("user_id").alias("known_users"), F.count(F.lit(1)).alias("distinct_rows"))


def plays_per_artist(log: DataFrame, only_plays: bool = True) -> DataFrame:
    """Rows ``(artist, plays)``; a NULL artist counts 0 plays."""
    rows = log.filter(F.col("page") == PLAY_PAGE) if only_plays else log
    return rows.groupBy("artist").agg(F.count("artist").alias("plays"))


def top_artist(log: DataFrame) -> DataFrame:
    """The most played artist; of tied ones the first by name."""
    return top_k(plays_per_artist(log), 1, "plays", ["artist"])


def top_artists_with_ties(log: DataFrame) -> DataFrame:
    """Every artist that reaches the highest number of plays, over all pages."""
    return rows_at_maximum(plays_per_artist(log, only_plays=False), "plays")


def songs_per_hour(log: DataFrame) -> DataFrame:
    """Plays per hour of day, hours in numeric order."""
    hours = log.filter(F.col("page") == PLAY_PAGE).select(F.hour(from_epoch_millis(F.col("ts"))).alias("hour"))
    return hours.groupBy("hour").count().orderBy("hour")


def downgrade_timeline(log: DataFrame, **options) -> DataFrame:
    """Rows of known users with ``downgraded`` and ``phase``: how many downgrades lie at or after the row."""
    known = log.dropna("any", subset=["user_id", "session_id"]).filter(F.col("user_id").cast("string") != "")
    phased = label_by_anchor(known, ["user_id"], "ts", "page", DOWNGRADE_PAGE, "phase", **options)
    return phased.withColumn("downgraded", F.when(F.col("page") == DOWNGRADE_PAGE, 1).otherwise(0))


def top_log_values(lines: DataFrame, field: str, k: int = 10) -> DataFrame:
    """The k most frequent hosts, endpoints, … of an access log. A line that does not match has a NULL value."""
    counts = parse_lines(lines).groupBy(field).count()
    return top_k(counts, k, "count", [field])


def largest_responses(lines: DataFrame, k: int = 10, numeric: bool = True) -> DataFrame:
    """Endpoints by response size: in bytes, or by the raw text, which orders '9' above '10'."""
    by = "content_size_bytes" if numeric else "content_size"
    parsed = typed(parse_lines(lines)).select("endpoint", "content_size", "content_size_bytes")
    return top_k(parsed, k, by, ["endpoint", "content_size"]).select("endpoint", "content_size")


def title_words(posts: DataFrame, path: str = "data.title", lower: bool = False) -> DataFrame:
    """Word frequency in a nested text field."""
    return word_count(posts, F.col(path), lower)


def proper_nouns(annotated: DataFrame, column: str = "pos") -> DataFrame:
    """Frequency of the words tagged as proper nouns."""
    return tagged_words(annotated, column).groupBy("word").count()


def revenue_per_month(payments: DataFrame) -> DataFrame:
    """Exact money sum per calendar month, largest first."""
    monthly = payments.groupBy(F.month("payment_date").alias("month")).agg(
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("revenue")
    )
    return monthly.orderBy(F.desc("revenue"), "month")


def most_reviewed_listings(reviews: DataFrame, k: int = 5) -> DataFrame:
    counts = reviews.filter(F.col("comments").isNotNull()).groupBy("listing_id").agg(F.count(F.lit(1)).alias("reviews"))
    return top_k(counts, k, "reviews", ["listing_id"])


def listings_per_room_type(listings: DataFrame, k: int = 10) -> DataFrame:
    counts = listings.groupBy("room_type").agg(F.count(F.lit(1)).alias("num_listing"))
    return top_k(counts, k, "num_listing", ["room_type"])


def listings_per_month(
    calendars: DataFrame, listings: DataFrame, year: int, host_prefix: str, k: int = 12
) -> DataFrame:
    """Distinct listings with a calendar day per month of a year, for hosts whose id starts with the prefix."""
    hosts = listings.filter(F.startswith(F.col("host_id").cast("string"), F.lit(host_prefix)))
    days = calendars.filter(in_year(F.col("date"), year)).select(
        F.date_trunc("month", "date").alias("month"), "listing_id"
    )
    # A pair once is enough: dropping repeats before the join shrinks what it shuffles.
    pairs = days.distinct().join(hosts.select(F.col("id").alias("listing_id")), "listing_id", "left_semi")
    return pairs.groupBy("month").agg(F.countDistinct("listing_id").alias("num_listing_month")).orderBy("month").limit(k)


def distinct_artists(facts: DataFrame) -> DataFrame:
    return facts.select("artist_id").distinct()


def booking_rows(
    calendars: DataFrame, listings: DataFrame, reviews: DataFrame, hot_rows: int | None = None
) -> DataFrame:
    """Denormalised booking rows with an explicit column list."""
    homes = listings.select(F.col("id").alias("listing_id"), "name", "room_type")
    days = skewed_join(calendars.select("listing_id", "date", "adjusted_price"), homes, ["listing_id"], "left")
    grid = hot_grid(calendars, reviews, ["listing_id"], hot_rows)
    return fanout_join(days, reviews.select("listing_id", "review_id", "review_date"), ["listing_id"], grid=grid)


def sample(df: DataFrame, order: list[str | Column], n: int = 10) -> DataFrame:
    """The first n rows in a fixed order."""
    return df.orderBy(*order).limit(n)
