"""The named reports over the shared tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestar.functions.cleaning import yes_no
from lakestar.functions.timeparts import parse_time
from lakestar.functions.weblog import FIELDS, parse_lines, parse_map, typed
from lakestar.operators.running import mean_rows_between_anchors, running_sum
from lakestar.operators.upsert import last_write_wins
from lakestar.plans import reports
from lakestar.suite import query
from lakestar.suite.lodging import CALENDAR_SQL, LISTING_SQL, REVIEWS_SQL, calendar, listing, reviews
from lakestar.suite.tables import PLAY_LOG_SQL, VISITS_SQL, WEB_LOG_SQL, Tables

# --- page log ----------------------------------------------------------------

DAY_LOG_SQL = """day_log AS (
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS page,
           CASE WHEN o_totalprice < 150000 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS user_id FROM orders)"""


def day_log(t: Tables):
    """Orders as visits to the page of their day; small ones by a logged-out user."""
    blank = F.when(F.col("o_totalprice") < 150000, "").otherwise(F.col("o_custkey").cast("string"))
    return t.orders.select(F.to_date("o_orderdate").cast("string").alias("page"), blank.alias("user_id"))


NOT_VISITED_SQL = f"""WITH {DAY_LOG_SQL}
SELECT DISTINCT page FROM day_log EXCEPT SELECT page FROM day_log WHERE user_id = ''"""


@query("pages_not_visited", NOT_VISITED_SQL)
def pages_not_visited(t: Tables):
    return reports.pages_not_visited(day_log(t))


@query("pages_not_visited_sql", NOT_VISITED_SQL)
def pages_not_visited_sql(t: Tables):
    return reports.pages_not_visited_sql(day_log(t))


@query("count_users_of_gender", f"""WITH {PLAY_LOG_SQL}
SELECT count(DISTINCT user_id) AS known_users, (SELECT count(*) FROM (SELECT DISTINCT user_id FROM play_log
       WHERE gender = 'F')) AS distinct_rows FROM play_log WHERE gender = 'F'""")
def count_users_of_gender(t: Tables):
    return reports.count_users(t.play_log(songs=False))


@query("top_artist", f"""WITH {PLAY_LOG_SQL}
SELECT artist, count(artist) AS plays FROM play_log WHERE page = 'NextSong' GROUP BY artist
ORDER BY plays DESC, artist LIMIT 1""")
def top_artist(t: Tables):
    return reports.top_artist(t.play_log(users=False))


@query("top_artists_with_ties", f"""WITH {PLAY_LOG_SQL}, counts AS (
    SELECT artist, count(artist) AS plays FROM play_log GROUP BY artist)
SELECT artist, plays FROM counts WHERE plays = (SELECT max(plays) FROM counts)""")
def top_artists_with_ties(t: Tables):
    return reports.top_artists_with_ties(t.play_log(users=False))


@query("mean_songs_between_home", f"""WITH {VISITS_SQL}, periods AS (
    SELECT user_id, page, sum(CASE WHEN page = 'Home' THEN 1 ELSE 0 END) OVER (
           PARTITION BY user_id ORDER BY ts_us DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS period
    FROM visits WHERE page IN ('NextSong', 'Home'))
SELECT avg(n) AS mean_rows FROM (SELECT count(*) AS n FROM periods WHERE page = 'NextSong' GROUP BY user_id, period)""")
def mean_songs_between_home(t: Tables):
    return mean_rows_between_anchors(t.events, ["user_id"], "ts", "event_type", "view", "signup")


@query("mean_songs_between_home_rows", f"""WITH {VISITS_SQL}, periods AS (
    SELECT user_id, page, sum(CASE WHEN page = 'Home' THEN 1 ELSE 0 END) OVER (
           PARTITION BY user_id ORDER BY ts_us DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS period
    FROM visits WHERE page IN ('NextSong', 'Home'))
SELECT avg(n) AS mean_rows FROM (SELECT count(*) AS n FROM periods WHERE page = 'NextSong' GROUP BY user_id, period)""")
def mean_songs_between_home_rows(t: Tables):
    return mean_rows_between_anchors(
        t.events, ["user_id"], "ts", "event_type", "view", "signup", frame="rows", tiebreak=["event_id"]
    )


@query("songs_per_hour", f"""WITH {VISITS_SQL}
SELECT CAST(hour(make_timestamp(ts * 1000)) AS INTEGER) AS hour, count(*) AS count FROM visits
WHERE page = 'NextSong' GROUP BY 1""")
def songs_per_hour(t: Tables):
    return reports.songs_per_hour(t.visits())


@query("downgrade_timeline", f"""WITH {VISITS_SQL}
SELECT event_id, user_id, ts, page, CAST(page = 'Submit Downgrade' AS INTEGER) AS downgraded,
       CAST(sum(CASE WHEN page = 'Submit Downgrade' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts DESC
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS phase FROM visits""")
def downgrade_timeline(t: Tables):
    return reports.downgrade_timeline(t.visits()).select("event_id", "user_id", "ts", "page", "downgraded", "phase")


def _day_totals(frame: str):
    """Line items per return flag by ship date: many equal dates, so the two frames differ."""
    return f"""SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate_us, l_quantity,
       CAST(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_returnflag ORDER BY {frame}) AS BIGINT) AS so_far
FROM (SELECT *, CAST(epoch_us(l_shipdate) AS BIGINT) AS l_shipdate_us FROM lineitem)"""


def _line_items(t: Tables):
    return t.lineitem.select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_suppkey", "l_extendedprice",
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("l_shipdate_us"),
    )


@query("running_sum_range", _day_totals("l_shipdate_us DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"))
def running_sum_range(t: Tables):
    # Three keys hold all rows: each is hot and gets sliced.
    summed = running_sum(_line_items(t), ["l_returnflag"], "l_shipdate_us", F.col("l_quantity").cast("bigint"), "so_far")
    return summed.select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate_us", "l_quantity", "so_far")


TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("running_sum_rows", _day_totals(
    f"l_shipdate_us DESC, {', '.join(TIES)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"))
def running_sum_rows(t: Tables):
    summed = running_sum(
        _line_items(t), ["l_returnflag"], "l_shipdate_us", F.col("l_quantity").cast("bigint"), "so_far",
        frame="rows", tiebreak=TIES,
    )
    return summed.select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate_us", "l_quantity", "so_far")


@query("running_sum_with_nulls", """SELECT l_partkey, l_orderkey, l_linenumber, l_quantity,
       CAST(epoch_us(l_shipdate) AS BIGINT) AS l_shipdate_us,
       CAST(sum(CASE WHEN l_linenumber % 3 <> 0 AND l_quantity > 10 THEN l_quantity END) OVER (PARTITION BY l_returnflag
            ORDER BY epoch_us(l_shipdate) DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS so_far FROM lineitem""")
def running_sum_with_nulls(t: Tables):
    # The same hot keys with values that are NULL for part of the rows.
    some = F.when((F.col("l_linenumber") % 3 != 0) & (F.col("l_quantity") > 10), F.col("l_quantity").cast("bigint"))
    summed = running_sum(_line_items(t), ["l_returnflag"], "l_shipdate_us", some, "so_far")
    return summed.select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate_us", "l_quantity", "so_far")


@query("latest_event_per_session", f"""WITH {VISITS_SQL}
SELECT user_id, session_id, ts_us, page, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, session_id ORDER BY ts_us DESC, event_id DESC) AS rn FROM visits)
WHERE rn = 1""")
def latest_event_per_session(t: Tables):
    visits = t.visits().select("user_id", "session_id", "ts_us", "page", "event_id")
    return last_write_wins(visits, ["user_id", "session_id"], ["ts_us", "event_id"])


@query("pages_seen", f"WITH {VISITS_SQL} SELECT DISTINCT page FROM visits")
def pages_seen(t: Tables):
    return t.visits().select("page").distinct().orderBy("page")


# --- access log --------------------------------------------------------------


@query("web_log_parsed", f"""WITH {WEB_LOG_SQL}
SELECT event_id, parse_ok, {', '.join(f for f in FIELDS if f != 'response_code')},
       CAST(response_code AS INTEGER) AS response_code, CAST(content_size AS BIGINT) AS content_size_bytes,
       CAST(epoch(strptime(date_time, '%d/%b/%Y:%H:%M:%S +0000')) AS BIGINT) AS request_second FROM parsed""")
def web_log_parsed(t: Tables):
    parsed = typed(parse_lines(t.web_log()))
    return parsed.withColumn("request_second", F.unix_seconds("request_time")).drop("request_time", "value")


@query("web_log_map_fields", f"WITH {WEB_LOG_SQL} SELECT event_id, host, endpoint, content_size FROM parsed")
def web_log_map_fields(t: Tables):
    lines = t.web_log().select("event_id", parse_map(F.col("value")).alias("parsed"))
    return lines.select(
        "event_id", *[F.try_element_at("parsed", F.lit(f)).alias(f) for f in ("host", "endpoint", "content_size")]
    )


def _top_sql(field: str) -> str:
    return f"""WITH {WEB_LOG_SQL} SELECT {field}, count(*) AS count FROM parsed GROUP BY {field}
ORDER BY count DESC, {field} NULLS FIRST LIMIT 10"""


@query("top_hosts", _top_sql("host"))
def top_hosts(t: Tables):
    return reports.top_log_values(t.web_log(), "host")


@query("top_endpoints", _top_sql("endpoint"))
def top_endpoints(t: Tables):
    return reports.top_log_values(t.web_log(), "endpoint")


def _largest_sql(by: str) -> str:
    return f"""WITH {WEB_LOG_SQL} SELECT endpoint, content_size FROM parsed
ORDER BY {by} DESC NULLS LAST, endpoint NULLS FIRST, content_size NULLS FIRST LIMIT 10"""


@query("largest_responses", _largest_sql("CAST(content_size AS BIGINT)"))
def largest_responses(t: Tables):
    return reports.largest_responses(t.web_log())


@query("largest_responses_as_text", _largest_sql("content_size"))
def largest_responses_as_text(t: Tables):
    return reports.largest_responses(t.web_log(), numeric=False)


# --- text --------------------------------------------------------------------


def posts(t: Tables):
    """Documents as nested posts."""
    return t.documents.select(F.struct(F.col("text").alias("title"), F.col("source").alias("author")).alias("data"))


@query("title_word_frequency", r"""SELECT word, count(*) AS count FROM (
    SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents) GROUP BY word""")
def title_word_frequency(t: Tables):
    return reports.title_words(posts(t))


@query("top_words_any_case", r"""SELECT word, count(*) AS count FROM (
    SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents) GROUP BY word
ORDER BY count DESC, word LIMIT 20""")
def top_words_any_case(t: Tables):
    return reports.top_k(reports.title_words(posts(t), lower=True), 20, "count", ["word"])


def annotated(t: Tables):
    """Document words as annotations; capitalised ones carry the proper-noun tags."""
    words = F.split("text", r"\s+")

    def tag(w: Column) -> Column:
        noun = F.when(F.endswith(w, F.lit("s")), "NNPS").otherwise("NNP")
        return F.when(F.substring(w, 1, 1).between("A", "Z"), noun).otherwise("NN")

    pos = F.transform(
        words, lambda w: F.struct(tag(w).alias("result"), F.create_map(F.lit("word"), w).alias("metadata"))
    )
    return t.documents.select("doc_id", pos.alias("pos"))


@query("proper_noun_frequency", r"""SELECT word, count(*) AS count FROM (
    SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
WHERE word[1] BETWEEN 'A' AND 'Z' GROUP BY word""")
def proper_noun_frequency(t: Tables):
    return reports.proper_nouns(annotated(t))


@query("annotation_tags", r"""SELECT CASE WHEN word[1] NOT BETWEEN 'A' AND 'Z' THEN 'NN'
       WHEN word LIKE '%s' THEN 'NNPS' ELSE 'NNP' END AS tag, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents) GROUP BY 1""")
def annotation_tags(t: Tables):
    return annotated(t).select(F.explode("pos.result").alias("tag")).groupBy("tag").count()


@query("props_by_path", """SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n
FROM events GROUP BY 1""")
def props_by_path(t: Tables):
    as_map = F.from_json("props", "map<string,int>")
    return t.events.select(F.try_element_at(as_map, F.lit("k")).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


# --- money and lodging reports -----------------------------------------------


@query("revenue_per_month", """SELECT CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1""")
def revenue_per_month(t: Tables):
    text = F.to_date("o_orderdate").cast("string")  # payment files hold dates as text
    payments = t.orders.select(parse_time(text).alias("payment_date"), F.col("o_totalprice").alias("amount"))
    return reports.revenue_per_month(payments).withColumn("revenue", F.col("revenue").cast("double"))


@query("most_reviewed_listings", f"""WITH {REVIEWS_SQL}
SELECT listing_id, count(*) AS reviews FROM reviews WHERE comments IS NOT NULL GROUP BY listing_id
ORDER BY reviews DESC, listing_id LIMIT 5""")
def most_reviewed_listings(t: Tables):
    return reports.most_reviewed_listings(reviews(t))


@query("listings_per_room_type", f"""WITH {LISTING_SQL}
SELECT room_type, count(*) AS num_listing FROM listing GROUP BY room_type ORDER BY num_listing DESC, room_type LIMIT 10""")
def listings_per_room_type(t: Tables):
    return reports.listings_per_room_type(listing(t))


@query("listings_per_month_for_hosts", f"""WITH {LISTING_SQL}, {CALENDAR_SQL}
SELECT CAST(epoch(date_trunc('month', make_timestamp(date_us))) AS BIGINT) AS month_second,
       count(DISTINCT id) AS num_listing_month
FROM calendar JOIN listing ON listing_id = id
WHERE year(make_timestamp(date_us)) = 1997 AND CAST(host_id AS VARCHAR) LIKE '10%' GROUP BY 1""")
def listings_per_month_for_hosts(t: Tables):
    monthly = reports.listings_per_month(calendar(t), listing(t), 1997, "10")
    return monthly.select(F.unix_seconds("month").alias("month_second"), "num_listing_month")


@query("booking_rows", f"""WITH {LISTING_SQL}, {CALENDAR_SQL}, {REVIEWS_SQL}
SELECT c.listing_id, date_us, CAST(adjusted_price AS DOUBLE) AS adjusted_price, name, room_type, review_id,
       review_us FROM calendar c LEFT JOIN listing ON listing.id = c.listing_id
LEFT JOIN reviews r ON r.listing_id = c.listing_id""")
def booking_rows(t: Tables):
    rows = reports.booking_rows(calendar(t), listing(t), reviews(t))
    return rows.select(
        "listing_id", F.unix_micros("date").alias("date_us"), F.col("adjusted_price").cast("double"), "name",
        "room_type", "review_id", F.unix_micros("review_date").alias("review_us"),
    )


@query("sample_rows", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def sample_rows(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return reports.sample(rows, [F.desc("o_totalprice"), "o_orderkey"])


@query("availability_flags", f"""SELECT o_orderstatus AS flag, count(*) AS days,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS available
FROM orders GROUP BY o_orderstatus""")
def availability_flags(t: Tables):
    flag = F.when(F.col("o_orderstatus") == "O", "t").when(F.col("o_orderstatus") == "F", "f").otherwise("?")
    days = t.orders.select(F.col("o_orderstatus").alias("flag"), yes_no(flag).alias("available"))
    return days.groupBy("flag").agg(
        F.count(F.lit(1)).alias("days"), F.count_if(F.col("available")).alias("available")
    )
