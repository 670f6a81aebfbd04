import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakestar import contracts as c
from lakestar.operators import quality
from lakestar.plans import lodging, music, reports
from lakestar.plans.load import published, run_load, run_lodging_load
from lakestar.streaming.incremental import file_stream
from lakestar.streaming.star import StarStream

T0 = 1541121934796


def songs(spark):
    data = [
        ("A1", None, "Rome", None, "Trio", 200.5, 1, "S2", "Blue", 2001),
        ("A1", None, "Rome", None, "Trio", 200.5, 1, "S1", "Blue", 2001),  # same natural key, two ids
        ("A2", 1.0, "Oslo", 2.0, "Duo", 180.0, 1, "S3", "Blue", 0),        # same title, other artist
        ("A3", None, "Bern", None, "Trio", 99.0, 1, "S4", "Red", None),    # same artist name, other id
        ("A3", None, "Bern", None, "Trio", 99.0, 1, None, "Lost", None),   # no song id
    ]
    return spark.createDataFrame(data, c.STAGING_SONGS.schema)


def event(page="NextSong", song="Blue", artist="Trio", length=200.5, user="1", ts=T0, item=0, level="free", first="Ann"):
    return dict(
        artist=artist, first_name=first, last_name="Lee", gender="F", item_in_session=item, length=length, level=level,
        location="Rome", page=page, session_id=5, song=song, ts=ts, user_agent="ua", user_id=user,
    )


def events(spark):
    data = [
        event(),
        event(ts=T0 + 1, item=1),                                            # same second, other millisecond
        event(song="Blue", artist="Duo", length=180.0, ts=T0 + 5000, item=2, level="paid", first="Anna"),
        event(song="None such", ts=T0 + 6000, item=3, user="2"),
        event(page="Home", song=None, artist=None, length=None, ts=T0 + 7000, item=4),
        event(page=None, ts=T0 + 8000, item=5, user="9"),
        event(user=None, ts=T0 + 9000, item=6),
    ]
    return spark.createDataFrame([{f.name: e.get(f.name) for f in c.STAGING_EVENTS.schema} for e in data],
                                 c.STAGING_EVENTS.schema)


def test_dimensions(spark):
    assert [r[0] for r in rows(music.songs(songs(spark)))] == ["S1", "S2", "S3", "S4"]
    assert [r[:2] for r in rows(music.artists(songs(spark)))] == [("A1", "Trio"), ("A2", "Duo"), ("A3", "Trio")]
    assert len(rows(music.users_distinct(events(spark)))) == 3
    time = music.time_dimension(events(spark), "seconds")
    assert time.count() == 4 and music.time_dimension(events(spark)).count() == 5


def test_fact_variants(spark):
    def ids(**options):
        facts = music.songplays(events(spark), songs(spark), **options)
        return sorted((r.song_id or "-", r.artist_id or "-") for r in facts.collect())

    everything = [("-", "-"), ("S1", "A1"), ("S1", "A1"), ("S1", "A1"), ("S2", "A1"), ("S2", "A1"), ("S2", "A1"), ("S3", "A2")]
    assert ids() == everything
    assert ids(how="inner") == everything[1:]
    assert ids(ambiguous="first") == [("-", "-"), ("S1", "A1"), ("S1", "A1"), ("S1", "A1"), ("S3", "A2")]
    # Two plays within one second collapse when whole seconds are kept and rows made distinct.
    collapsed = music.songplays(events(spark), songs(spark), "inner", "first", "seconds", distinct=True)
    assert collapsed.count() == 3
    facts = music.songplays(events(spark), songs(spark))
    assert facts.select("songplay_id").distinct().count() == facts.count()


def test_fact_with_unique_time_never_multiplies(spark):
    facts = music.songplays(events(spark), songs(spark))
    assert music.with_time(facts, music.time_dimension(events(spark))).count() == facts.count()


def test_question_tables(spark):
    again = event(song="Red", artist="Trio", length=99.0, ts=T0 + 50_000, item=0)  # same key, written later
    more = events(spark).unionByName(spark.createDataFrame(
        [{f.name: again.get(f.name) for f in c.STAGING_EVENTS.schema}], c.STAGING_EVENTS.schema))
    items = music.session_item(more)
    assert rows(music.song_at(items, 5, 0)) == [("Trio", "Red", 99.0)]
    assert items.count() == 6  # the row without an artist has no place here
    heard = music.songs_of_session(conformed(music.user_session(more)), 1, 5)
    assert [r.item_in_session for r in heard.collect()] == [0, 1, 2]
    listeners = music.listeners(music.user_song(more), "Blue")
    assert {r.user_id for r in listeners.collect()} == {"1", "9"}
    assert music.listeners(music.user_song(more), "bl", prefix=True).count() == listeners.count()
    assert music.event_subset(more).columns == list(music.EVENT_SUBSET)


def conformed(df):
    return df.withColumn("user_id", F.col("user_id").cast("bigint"))


def test_load_is_repeatable_and_clean(spark, tmp_path):
    one_id = songs(spark).filter("song_id IS NULL OR song_id <> 'S2'")
    known = events(spark).filter("user_id IS NOT NULL")
    for _ in range(2):
        loaded = run_load(known, one_id, str(tmp_path))
        quality.assert_clean(loaded["findings"])
        assert loaded["songplays"].count() == 4
        assert rows(loaded["users"].select("user_id", "first_name", "level")) == [(1, "Ann", "paid"), (2, "Ann", "free")]


def test_load_reports_a_missing_user(spark, tmp_path):
    known = events(spark).filter("user_id IS NOT NULL")
    run_load(known, songs(spark).filter("song_id IS NULL OR song_id <> 'S2'"), str(tmp_path))
    before = rows(published(spark, str(tmp_path), c.SONGPLAYS))
    with pytest.raises(quality.QualityError, match="not_null songplays.user_id: 1"):
        run_load(events(spark), songs(spark), str(tmp_path))
    assert rows(published(spark, str(tmp_path), c.SONGPLAYS)) == before  # nothing was published over it
    loaded = run_load(events(spark), songs(spark), str(tmp_path), strict=False)
    assert loaded["findings"].filter("bad > 0").count() > 0
    assert loaded["users"].filter("user_id IS NULL").count() == 0


# --- reports: the frame and the SQL forms agree -------------------------------


def test_pages_not_visited_forms_agree(spark):
    log = spark.createDataFrame(
        [("", "Home"), ("", "Login"), ("1", "Home"), ("1", "Help"), ("2", None), (None, "Login")], "user_id string, page string"
    )
    assert rows(reports.pages_not_visited(log)) == [(None,), ("Help",)]
    assert rows(reports.pages_not_visited_sql(log)) == [(None,), ("Help",)]


def test_user_counts_treat_null_differently(spark):
    log = spark.createDataFrame([("1", "F"), ("1", "F"), (None, "F"), ("2", "M")], "user_id string, gender string")
    assert tuple(reports.count_users(log).first()) == (1, 2)


def test_top_artist_and_ties(spark):
    log = spark.createDataFrame(
        [("B", "NextSong"), ("A", "NextSong"), (None, "NextSong"), (None, "NextSong"), ("B", "Home")], "artist string, page string"
    )
    assert tuple(reports.top_artist(log).first()) == ("A", 1)
    assert rows(reports.top_artists_with_ties(log)) == [("B", 2)]
    assert dict(rows(reports.plays_per_artist(log)))[None] == 0


def test_downgrade_timeline_drops_unknown_users(spark):
    data = [("1", 5, 10, "Home"), ("1", 5, 20, "Submit Downgrade"), ("1", 5, 30, "Home"), ("", 5, 1, "Home"), (None, 5, 1, "Home")]
    log = spark.createDataFrame(data, "user_id string, session_id int, ts bigint, page string")
    got = reports.downgrade_timeline(log).orderBy("ts").collect()
    assert [(r.phase, r.downgraded) for r in got] == [(1, 0), (1, 1), (0, 0)]


def test_response_size_orders(spark):
    line = 'h - - [01/Aug/1995:00:00:01 -0400] "GET /{} HTTP/1.0" 200 {}'
    lines = spark.createDataFrame([(line.format("a", 9),), (line.format("b", 10),), ("junk",)], "value string")
    assert reports.largest_responses(lines, 1).first().endpoint == "/b"
    assert reports.largest_responses(lines, 1, numeric=False).first().endpoint == "/a"
    assert [r["count"] for r in reports.top_log_values(lines, "host").collect()] == [2, 1]


# --- lodging -------------------------------------------------------------------


def test_listing_is_merged_cleaned_and_typed(spark):
    detailed = spark.createDataFrame(
        [(1, "Den", "7", "2015-03-01", "", None, "Loft", "x"), (2, "Attic", "8", "not a date", "4.87", None, "Room", "y")],
        "id bigint, name string, host_id string, host_since string, review_scores_rating string, bathrooms string,"
        " room_type string, price string",
    )
    summary = spark.createDataFrame(
        [(1, "Den", "$1,250.00", 0.5, "Old Town"), (2, "Attic", "90", None, None)],
        "id bigint, name string, price string, reviews_per_month double, neighbourhood string",
    )
    got = lodging.listing(detailed, summary)
    assert got.columns == c.LISTING.columns
    first, second = got.orderBy("id").collect()
    assert (first.name, first.price, first.month, first.review_scores_rating) == ("Den", Decimal("1250.00"), 3, 0.0)
    assert (second.review_scores_rating, second.reviews_per_month, second.host_since) == (4.87, 0.0, None)
    assert second.neighbourhood == ""


def lodging_tables(spark):
    listings = spark.createDataFrame([(1, "Den"), (2, "Attic")], "id bigint, name string")
    listings = c.conform(listings, c.LISTING)
    calendars = lodging.calendar(spark.createDataFrame(
        [(1, "2022-01-01", "t", "$10.00", 1, 9), (1, "2022-01-02", "f", "$1,000.50", 1, 9), (2, "2022-02-01", "?", "", 1, 9),
         (3, "2023-01-01", "t", "$5.00", 1, 9)],
        "listing_id bigint, date string, available string, adjusted_price string, minimum_nights int, maximum_nights int"))
    reviews = lodging.reviews(spark.createDataFrame(
        [(1, 11, dt.datetime(2022, 5, 1), 100, "a", "nice"), (1, 12, dt.datetime(2022, 6, 1), 101, "b", "line\nbreak"),
         (2, 13, dt.datetime(2022, 6, 1), 102, "c", None), (9, 14, dt.datetime(2022, 6, 1), 103, "d", "orphan")],
        "listing_id bigint, id bigint, date timestamp, reviewer_id bigint, reviewer_name string, comments string"))
    return calendars, listings, reviews


@pytest.mark.parametrize("hot_rows", [10**9, 1])
def test_bookings_keep_days_without_reviews(spark, hot_rows):
    calendars, listings, reviews = lodging_tables(spark)
    assert reviews.count() == 3  # the incomplete review is dropped
    got = lodging.bookings(calendars, listings, reviews, hot_rows)
    assert got.columns == c.BOOKINGS.columns
    seen = sorted((r.id or 0, r.review_id or 0, r.month_review or 0) for r in got.collect())
    assert seen == [(0, 0, 0), (1, 11, 5), (1, 11, 5), (1, 12, 6), (1, 12, 6), (2, 0, 0)]
    assert reports.booking_rows(calendars, listings, reviews, hot_rows).count() == 6


def test_calendar_values(spark):
    calendars, _, _ = lodging_tables(spark)
    got = {(r.listing_id, r.date.day): (r.available, r.adjusted_price) for r in calendars.collect()}
    assert got[(1, 2)] == (False, Decimal("1000.50")) and got[(2, 1)] == (None, None)


def test_listings_per_month_needs_a_matching_host(spark):
    calendars, listings, _ = lodging_tables(spark)
    listings = listings.withColumn("host_id", (F.col("id") + 888).cast("bigint"))
    got = reports.listings_per_month(calendars, listings, 2022, "89")
    assert [(r.month.month, r.num_listing_month) for r in got.collect()] == [(2, 1)]


def test_lodging_load(spark, tmp_path):
    detailed = spark.createDataFrame(
        [(1, "Den", "7", "2015-03-01", "4.5", "Loft", "old"), (2, "Attic", "8", "2016-04-01", "", "Room", "old")],
        "id bigint, name string, host_id string, host_since string, review_scores_rating string, room_type string, price string",
    )
    summary = spark.createDataFrame([(1, "Den", "$12.00"), (2, "Attic", "$9.50")], "id bigint, name string, price string")
    days = spark.createDataFrame(
        [(1, "2022-01-01", "t", "$10.00"), (1, "2022-01-02", "f", "$11.00"), (2, "2022-01-01", "t", "$12.00")],
        "listing_id bigint, date string, available string, adjusted_price string",
    )
    hoods = spark.createDataFrame([("North", "A"), ("North", "B")], "neighbourhood_group string, neighbourhood string")
    reviews = spark.createDataFrame(
        [(1, 11, dt.datetime(2022, 5, 1), 100, "a", "ok"), (1, 12, dt.datetime(2022, 6, 1), 101, "b", "fine")],
        "listing_id bigint, id bigint, date timestamp, reviewer_id bigint, reviewer_name string, comments string",
    )
    loaded = run_lodging_load(detailed, summary, days, hoods, reviews, str(tmp_path))
    quality.assert_clean(loaded["findings"])
    assert loaded["bookings"].count() == 5
    assert {r.detail for r in loaded["findings"].filter("check = 'row_parity'").collect()} == {"rows"}
    assert loaded["findings"].filter("check = 'row_parity'").count() == 5


def test_star_by_streams_equals_the_batch_load(spark, tmp_path):
    one_id = songs(spark).filter("song_id IS NULL OR song_id <> 'S2'")
    known = events(spark).filter("user_id IS NOT NULL")
    one_id.repartition(2).write.json(str(tmp_path / "song_files"))
    known.repartition(3).write.json(str(tmp_path / "event_files"))
    star = StarStream(str(tmp_path / "stream"))
    for _ in range(2):  # the second round finds no new files
        star.load_songs(file_stream(spark, str(tmp_path / "song_files"), c.STAGING_SONGS.schema, max_files=1))
        star.load_events(file_stream(spark, str(tmp_path / "event_files"), c.STAGING_EVENTS.schema, max_files=1))
    batch = run_load(known, one_id, str(tmp_path / "batch"))
    for name in ("songplays", "users", "time", "songs", "artists"):
        assert rows(getattr(star, name)(spark)) == rows(batch[name]), name


def test_events_before_songs_and_again(spark, tmp_path):
    one_id = songs(spark).filter("song_id IS NULL OR song_id <> 'S2'")
    known = events(spark).filter("user_id IS NOT NULL")
    one_id.write.json(str(tmp_path / "song_files"))
    known.repartition(3).write.json(str(tmp_path / "event_files"))
    files_ = file_stream(spark, str(tmp_path / "event_files"), c.STAGING_EVENTS.schema, max_files=1)
    star = StarStream(str(tmp_path / "stream"))
    star.load_events(files_)
    assert star.songplays(spark).filter("song_id IS NOT NULL").count() == 0
    star.load_songs(file_stream(spark, str(tmp_path / "song_files"), c.STAGING_SONGS.schema))
    n = star.songplays(spark).count()
    StarStream(str(tmp_path / "stream"), "again").load_events(files_)
    batch = run_load(known, one_id, str(tmp_path / "batch"))
    assert star.songplays(spark).count() == n and rows(star.songplays(spark)) == rows(batch["songplays"])
