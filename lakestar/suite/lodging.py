"""Listing, calendar, neighbourhood, review and booking tables over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestar.plans import lodging
from lakestar.suite import query
from lakestar.suite.tables import Tables

LISTING_SQL = """listing AS (
    SELECT c_custkey AS id, c_name AS name, 'in ' || n_name AS description, CAST(1000 + c_nationkey * 3 AS BIGINT) AS host_id,
           r_name AS host_name, epoch_us(CAST(DATE '2010-01-01' + c_nationkey * 37 AS TIMESTAMP)) AS host_since_us,
           'scrape' AS source, CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_regionkey AS DOUBLE) AS longitude,
           CAST(c_acctbal AS DECIMAL(12,2)) AS price, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE 4.5 END AS review_scores_rating,
           CASE WHEN c_acctbal > 9000 THEN 0.0 ELSE c_acctbal / 1000 END AS reviews_per_month,
           c_mktsegment AS room_type, n_name AS neighbourhood
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CALENDAR_SQL = """calendar AS (
    SELECT o_custkey AS listing_id, CAST(epoch_us(o_orderdate) AS BIGINT) AS date_us,
           CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS available,
           CAST(o_totalprice AS DECIMAL(12,2)) AS adjusted_price FROM orders)"""

REVIEWS_SQL = """reviews AS (
    SELECT user_id AS listing_id, event_id AS review_id, CAST(epoch_us(ts) AS BIGINT) AS review_us,
           user_id AS reviewer_id, event_type AS reviewer_name, props AS comments FROM events)"""


def listing_files(t: Tables):
    """Customers as the detailed and the summary listing file, prices as currency text."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    homes = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    host = (F.lit(1000) + F.col("c_nationkey") * 3).cast("bigint")
    price = F.concat(F.lit("$"), F.format_number("c_acctbal", 2))
    detailed = homes.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.concat(F.lit("in "), "n_name").alias("description"), host.alias("host_id"), F.col("r_name").alias("host_name"),
        F.date_add(F.to_date(F.lit("2010-01-01")), F.col("c_nationkey") * 37).cast("string").alias("host_since"),
        F.lit("scrape").alias("source"), F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"), price.alias("price"),
        F.when(F.col("c_acctbal") < 0, "").otherwise("4.5").alias("review_scores_rating"),
        F.col("c_mktsegment").alias("room_type"), F.lit(None).cast("string").alias("bathrooms"),
        F.lit(1).alias("minimum_nights"), F.lit(30).alias("maximum_nights"),
    )
    summary = homes.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), host.alias("host_id"),
        F.col("n_name").alias("neighbourhood"), price.alias("price"),
        F.when(F.col("c_acctbal") <= 9000, F.col("c_acctbal") / 1000).alias("reviews_per_month"),
        F.lit(1).alias("minimum_nights"),
    )
    return detailed, summary


def listing(t: Tables):
    return lodging.listing(*listing_files(t))


def calendar_file(t: Tables):
    flag = F.when(F.col("o_orderstatus") == "O", "t").when(F.col("o_orderstatus") == "F", "f")
    price = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return t.orders.select(
        F.col("o_custkey").alias("listing_id"), F.col("o_orderdate").alias("date"), flag.alias("available"),
        price.alias("adjusted_price"), F.lit(1).alias("minimum_nights"), F.lit(30).alias("maximum_nights"),
    )


def calendar(t: Tables):
    return lodging.calendar(calendar_file(t))


def review_file(t: Tables):
    return t.events.select(
        F.col("user_id").alias("listing_id"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("date"),
        F.col("user_id").alias("reviewer_id"), F.col("event_type").alias("reviewer_name"),
        F.col("props").alias("comments"),
    )


def reviews(t: Tables):
    return lodging.reviews(review_file(t))


def places(t: Tables):
    """Nations as neighbourhoods, regions as their groups."""
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("r_name").alias("neighbourhood_group"), F.col("n_name").alias("neighbourhood"))


@query("listing_merged_columns", f"""WITH {LISTING_SQL}
SELECT id, name, description, host_id, host_name, CAST(make_timestamp(host_since_us) AS DATE)::VARCHAR AS host_since, latitude, longitude,
       CASE WHEN review_scores_rating = 0 THEN '' ELSE '4.5' END AS review_scores_rating, room_type,
       neighbourhood, format('${{:,.2f}}', CAST(price AS DOUBLE)) AS price, source,
       CASE WHEN CAST(price AS DOUBLE) <= 9000 THEN reviews_per_month END AS reviews_per_month,
       CAST(NULL AS VARCHAR) AS bathrooms, 1 AS minimum_nights
FROM listing""")
def listing_merged_columns(t: Tables):
    return lodging.merge_listings(*listing_files(t))


@query("listing_with_equal_columns", f"""WITH {LISTING_SQL}
SELECT id, name, host_name, latitude, longitude, neighbourhood, CAST(price AS DOUBLE) AS price
FROM (SELECT * REPLACE (latitude AS longitude, name AS host_name) FROM listing)""")
def listing_with_equal_columns(t: Tables):
    # Columns of the contract that agree on every row stay apart.
    detailed, summary = listing_files(t)
    same = detailed.withColumns({"longitude": F.col("latitude"), "host_name": F.col("name")})
    df = lodging.listing(same, summary).withColumn("price", F.col("price").cast("double"))
    return df.select("id", "name", "host_name", "latitude", "longitude", "neighbourhood", "price")


@query("listing_table", f"""WITH {LISTING_SQL}
SELECT id, CAST(month(make_timestamp(host_since_us)) AS INTEGER) AS month, name, description,
       CAST(host_id AS BIGINT) AS host_id, host_name, CAST(host_since_us AS BIGINT) AS host_since_us, source, latitude,
       longitude, CAST(price AS DOUBLE) AS price, CAST(review_scores_rating AS DOUBLE) AS review_scores_rating,
       reviews_per_month, room_type, neighbourhood FROM listing""")
def listing_table(t: Tables):
    df = listing(t).withColumn("host_since_us", F.unix_micros("host_since")).drop("host_since")
    return df.withColumn("price", F.col("price").cast("double"))


@query("calendar_table", f"""WITH {CALENDAR_SQL}
SELECT listing_id, CAST(month(make_timestamp(date_us)) AS INTEGER) AS month, date_us, available,
       CAST(adjusted_price AS DOUBLE) AS adjusted_price, 1 AS minimum_nights, 30 AS maximum_nights FROM calendar""")
def calendar_table(t: Tables):
    df = calendar(t).withColumn("date_us", F.unix_micros("date")).drop("date")
    return df.withColumn("adjusted_price", F.col("adjusted_price").cast("double"))


@query("neighbourhoods_table", """SELECT r_name AS neighbourhood_group, n_name AS neighbourhood
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def neighbourhoods_table(t: Tables):
    return lodging.neighbourhoods(places(t))


@query("reviews_table", f"""WITH {REVIEWS_SQL}
SELECT listing_id, review_id, review_us, reviewer_id, reviewer_name, comments,
       CAST(month(make_timestamp(review_us)) AS INTEGER) AS month FROM reviews""")
def reviews_table(t: Tables):
    return reviews(t).withColumn("review_us", F.unix_micros("review_date")).drop("review_date")


@query("bookings_table", f"""WITH {LISTING_SQL}, {CALENDAR_SQL}, {REVIEWS_SQL}
SELECT id, CAST(month(make_timestamp(review_us)) AS INTEGER) AS month_review, name, description,
       CAST(host_id AS BIGINT) AS host_id, host_name, CAST(host_since_us AS BIGINT) AS host_since_us, source, latitude,
       longitude, CAST(adjusted_price AS DOUBLE) AS adjusted_price, review_id, review_us, reviewer_id,
       CAST(review_scores_rating AS DOUBLE) AS review_scores_rating, reviews_per_month, room_type
FROM calendar c LEFT JOIN listing ON listing.id = c.listing_id LEFT JOIN reviews r ON r.listing_id = c.listing_id""")
def bookings_table(t: Tables):
    df = lodging.bookings(calendar(t), listing(t), reviews(t))
    return df.withColumns(
        {
            "host_since_us": F.unix_micros("host_since"), "review_us": F.unix_micros("review_date"),
            "adjusted_price": F.col("adjusted_price").cast("double"),
        }
    ).drop("host_since", "review_date")
