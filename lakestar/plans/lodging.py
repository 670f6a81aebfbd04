"""Lodging domain: listing, calendar, neighbourhoods, reviews and the bookings fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar import contracts as c
from lakestar.contracts import conform
from lakestar.functions.cleaning import blank_to_zero, fill_text, money, yes_no
from lakestar.operators.columns import drop_duplicate_columns, merge_with_suffixes, strip_suffix
from lakestar.operators.skew import fanout_join, hot_grid, skewed_join

# Columns in which a blank stands for zero.
ZERO_IF_BLANK = (
    "bedrooms", "beds", "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "reviews_per_month", "review_scores_communication", "review_scores_location",
    "review_scores_value",
)
# Columns the detailed file repeats from the summary, and one that is always empty.
REPEATED = ("maximum_nights", "minimum_nights", "price")
ALWAYS_EMPTY = ("bathrooms",)


def merge_listings(detailed: DataFrame, summary: DataFrame) -> DataFrame:
    """Detailed rows widened by the summary file; what the two files both hold is kept once.

    Only columns of one file are compared with columns of the other. Columns of the contract stay
    even if they equal another one.
    """
    merged = merge_with_suffixes(detailed.drop(*REPEATED), summary, "id")
    theirs = [n for n in merged.columns if n.endswith("_y") or (n in summary.columns and n != "id")]
    ours = [n for n in merged.columns if n not in theirs and n != "id"]
    wanted = [n for n in theirs if n in c.LISTING.columns]
    return strip_suffix(drop_duplicate_columns(merged, [(a, b) for b in theirs for a in ours], wanted), "_x")


def clean_listings(merged: DataFrame) -> DataFrame:
    """Blanks filled, numbers and prices parsed, typed by the contract."""
    df = fill_text(merged.drop(*ALWAYS_EMPTY))
    kinds = dict(df.dtypes)
    df = df.withColumns({n: blank_to_zero(F.col(n)) for n in ZERO_IF_BLANK if kinds.get(n) == "string"})
    df = df.na.fill(0, subset=[n for n in ZERO_IF_BLANK if n in kinds and kinds[n] != "string"])
    if kinds.get("price") == "string":
        df = df.withColumn("price", money(F.col("price")))
    df = df.withColumn("host_since", F.col("host_since").try_cast("timestamp"))
    return conform(df.withColumn("month", F.month("host_since")), c.LISTING)


def listing(detailed: DataFrame, summary: DataFrame) -> DataFrame:
    return clean_listings(merge_listings(detailed, summary))


def calendar(raw: DataFrame) -> DataFrame:
    """Days of a listing; ``t`` / ``f`` and price text parsed when the file has them as text."""
    df, kinds = raw, dict(raw.dtypes)
    if kinds["available"] == "string":
        df = df.withColumn("available", yes_no(F.col("available")))
    if kinds["adjusted_price"] == "string":
        df = df.withColumn("adjusted_price", money(F.col("adjusted_price")))
    df = df.withColumn("date", F.col("date").try_cast("timestamp"))
    return conform(df.withColumn("month", F.month("date")), c.CALENDAR)


def neighbourhoods(raw: DataFrame) -> DataFrame:
    return conform(raw, c.NEIGHBOURHOODS)


def reviews(raw: DataFrame) -> DataFrame:
    """Complete reviews only: a NULL or NaN in any column drops the row."""
    named = raw.withColumnsRenamed({"id": "review_id", "date": "review_date"})
    return conform(named.na.drop("any").withColumn("month", F.month("review_date")), c.REVIEWS)


def bookings(calendars: DataFrame, listings: DataFrame, all_reviews: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Calendar days with their listing and, for each day, every review of the listing.

    Only the columns of the result enter the joins. The listing join is many to
    one; the review join is many to many and slices both sides, by one count of the
    keys of each.
    """
    listing_columns = [n for n in c.BOOKINGS.columns if n in c.LISTING.columns and n != "id"]
    homes = listings.select(F.col("id").alias("listing_id"), "id", *listing_columns)
    days = skewed_join(calendars.select("listing_id", "adjusted_price"), homes, ["listing_id"], "left")
    reviewed = all_reviews.select("listing_id", "review_id", "review_date", "reviewer_id")
    grid = hot_grid(calendars, all_reviews, ["listing_id"], hot_rows)
    joined = fanout_join(days, reviewed, ["listing_id"], "left", grid=grid)
    return joined.withColumn("month_review", F.month("review_date")).select(*c.BOOKINGS.columns)
