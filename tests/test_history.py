"""Tolerant keys, values carried forward, as-of joins, histories, sessions and late songs against plain Python."""

import json
import pathlib
import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakestar import contracts as c
from lakestar.contracts import struct
from lakestar.operators.asof import as_of_join, carry_last, interval_history
from lakestar.operators.sessions import sessions, streamed_sessions
from lakestar.operators.tolerant import lookups, segments, tolerant_key_join
from lakestar.plans import music
from lakestar.streaming.incremental import append_batch, file_stream, read_batches
from lakestar.streaming.star import StarStream
from lakestar.suite.files import _arrivals


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_texts_within_the_edits_share_a_segment(spark, edits):
    """All pairs of short words over two letters, and random edits of longer ones."""
    pick = random.Random(edits)
    words = ["".join(pick.choice("ab") for _ in range(n)) for n in range(8) for _ in range(12)]
    for _ in range(60):
        w = [pick.choice("abcdefg") for _ in range(pick.randint(5, 15))]
        words.append("".join(w))
        for _ in range(edits):
            at = pick.randrange(len(w))
            w[at:at + 1] = pick.choice([[], [pick.choice("xyz")], [w[at], "q"]]) if len(w) > 1 else w[at:at + 1]
        words.append("".join(w))
    words = sorted(set(words))
    df = spark.createDataFrame([(w,) for w in words], "w string")
    parts = {r.w: {tuple(x) for x in r.p} for r in df.select("w", segments("w", edits).alias("p")).collect()}
    looked = {r.w: {tuple(x) for x in r.p} for r in df.select("w", lookups("w", edits).alias("p")).collect()}
    assert all("".join(x[2] for x in sorted(parts[w])) == w for w in words)
    near = [(a, b) for a in words for b in words if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits]
    assert all(parts[a] & looked[b] for a, b in near) and len(near) >= len(words)


SONGS = struct("song_id string, artist_id string, title string, artist_name string, duration double")
HEARD = struct("id int, song string, artist string, length double")


def brute_match(play, catalogue, edits, within):
    _, song, artist, length = play
    if None in (song, artist, length):
        return (None, None)
    fold = lambda *x: "\x1f".join(" ".join(v.lower().split()) for v in x)
    found = []
    for song_id, artist_id, title, name, duration in catalogue:
        if None not in (title, name, duration) and abs(length - duration) <= within:
            d = distance(fold(song, artist), fold(title, name))
            if d <= edits:
                found.append((d, abs(length - duration), song_id, artist_id))
    return min(found)[2:] if found else (None, None)


def test_tolerant_join(spark):
    pick = random.Random(2)
    titles = ["Blue Moon", "Blue Noon", "Intro", "intro", "A", "", "The long way home", "The  long way home"]
    catalogue = [(f"S{i}", f"A{i % 7}", pick.choice(titles), pick.choice(["Ann", "Anne", "Bob & Co"]), 200 + pick.randint(0, 12) * 0.25) for i in range(120)]
    catalogue += [("S900", "A1", None, "Ann", 200.0), ("S901", "A1", "Intro", "Ann", None)]
    plays = [(i, pick.choice([*titles, "Blue Mon", "Blu Moon ", "Introo", "B", "xx", None]), pick.choice(["Ann", "An", "BOB & CO", "Bob & Coo", None]),
              pick.choice([None, 200 + pick.randint(-6, 18) * 0.25])) for i in range(300)]
    plays += [(1000 + i, "Blue Mon", "Ann", 200.5) for i in range(400)]  # a hot key
    log, side = spark.createDataFrame(plays, HEARD).repartition(4), spark.createDataFrame(catalogue, SONGS)
    for edits, within in ((0, 0.1), (1, 0.5), (2, 0.5), (2, 1.0)):
        got = tolerant_key_join(log, side, {"song": "title", "artist": "artist_name"}, ("length", "duration"), ["song_id", "artist_id"], edits, within)
        expected = sorted((p[0], *brute_match(p, catalogue, edits, within)) for p in plays)
        assert sorted(tuple(r) for r in got.select("id", "song_id", "artist_id").collect()) == expected
    inner = tolerant_key_join(log, side, {"song": "title", "artist": "artist_name"}, ("length", "duration"), ["song_id", "artist_id"], how="inner")
    plan = inner._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert inner.count() == sum(brute_match(p, catalogue, 2, 0.5)[0] is not None for p in plays)
    with pytest.raises(ValueError):
        tolerant_key_join(log, side, {"song": "title"}, ("length", "duration"), ["song_id"], 1, 0)


def joined_rows(node):
    """Rows out of the joins of a plan that has run."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return joined_rows(node.executedPlan())
    own = node.metrics().apply("numOutputRows").value() if "Join" in kind else 0
    below = [node.plan()] if kind.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
    return own + sum(map(joined_rows, below))


def test_tolerant_join_of_close_numbers(spark):
    """Many copies, numbers and lengths of one text within reach of each other: no key meets them all."""
    numbers = [200 + i / 512 for i in range(300)]
    catalogue = [(f"S{i}-{j}", f"A{j}", "Blue Moon", "Ann", n) for i, n in enumerate(numbers) for j in range(3)]
    plays = [(i, "Blue Mon", "Ann", 199.4 + i / 250) for i in range(450)]
    log, side = spark.createDataFrame(plays, HEARD), spark.createDataFrame(catalogue, SONGS)
    got = tolerant_key_join(log, side, {"song": "title", "artist": "artist_name"}, ("length", "duration"), ["song_id", "artist_id"])
    found = {r["id"]: (r["song_id"], r["artist_id"]) for r in got.collect()}
    for i, _, _, length in plays:
        off, at = min((abs(length - n), f"S{j}-0") for j, n in enumerate(numbers))
        assert found[i] == ((at, "A0") if off <= 0.5 else (None, None))
    assert joined_rows(got._jdf.queryExecution().executedPlan()) < 20 * (len(numbers) + len(plays))


def test_facts_with_tolerance(spark):
    song = {f.name: None for f in c.STAGING_SONGS.schema} | {"song_id": "S1", "artist_id": "A1", "title": "Blue Moon", "artist_name": "Ann", "duration": 200.0}
    event = {f.name: None for f in c.STAGING_EVENTS.schema} | {"page": "NextSong", "ts": 1, "session_id": 1, "artist": "Ann"}
    events = [event | {"item_in_session": i, "song": s, "length": n} for i, (s, n) in enumerate((("Blue Moon", 200.0), ("Blue Mon", 200.5), ("Blue", 200.0), ("Blue Moon", 201.0)))]
    log = spark.createDataFrame(events, c.STAGING_EVENTS.schema).withColumn("item", F.col("item_in_session"))
    facts = music.songplays(log, spark.createDataFrame([song], c.STAGING_SONGS.schema), keep=("item",), tolerance=(2, 0.5))
    assert sorted((r["item"], r["song_id"]) for r in facts.collect()) == [(0, "S1"), (1, "S1"), (2, None), (3, None)]


def hot_log(seed, n=500):
    pick = random.Random(seed)
    return [(i, pick.choice([1, 1, 1, None, 2, 3]), pick.choice([None, *range(0, 60), 5, 5, 9000]), pick.choice([None, "a", "b", "c"])) for i in range(n)]


VALUES = struct("id int, key int, at bigint, value string")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("hot_rows", [None, 7, 60])
def test_carried_values(spark, hot_rows, descending):
    log = hot_log(4)
    got = carry_last(spark.createDataFrame(log, VALUES).repartition(5), ["key"], "at", F.col("value"), "before", ["id"], descending, hot_rows, bucket=4)
    expected, held = {}, {}
    by_time = (lambda r: (r[2] is None, -(r[2] or 0), r[0])) if descending else (lambda r: (r[2] is not None, r[2] or 0, r[0]))
    for i, key, _, value in sorted(log, key=by_time):
        expected[i] = held.get(key)
        held[key] = value if value is not None else held.get(key)
    assert {r.id: r.before for r in got.collect()} == expected


def test_carrying_needs_an_order_that_can_be_cut(spark):
    with pytest.raises(TypeError):
        carry_last(spark.createDataFrame(hot_log(1, 5), VALUES), ["key"], "value", F.col("id"), "x", ["id"])
    assert carry_last(spark.createDataFrame([], VALUES), ["key"], "at", F.col("value"), "x", ["id"]).count() == 0


@pytest.mark.parametrize("hot_rows", [None, 9])
def test_as_of_join(spark, hot_rows):
    left, right = hot_log(5), [(i, k, a, v) for i, k, a, v in hot_log(6, 200)]
    got = as_of_join(
        spark.createDataFrame(left, VALUES).repartition(3), spark.createDataFrame(right, VALUES).withColumnsRenamed({"value": "held", "at": "since"}).repartition(4),
        ["key"], ("at", "since"), ["held"], ["id"], hot_rows, bucket=4)
    expected = {}
    for i, key, at, value in left:
        valid = [(a, j, v) for j, k, a, v in right if k == key and None not in (k, a, at) and a <= at]
        expected[i] = (key, at, value, max(valid)[2] if valid else None)
    assert got.columns == ["id", "key", "at", "value", "held"]
    assert {r.id: tuple(r)[1:] for r in got.collect()} == expected


@pytest.mark.parametrize("hot_rows", [None, 9])
def test_interval_history(spark, hot_rows):
    log = hot_log(7)
    got = interval_history(spark.createDataFrame(log, VALUES).repartition(3), ["key"], "at", "value", ["id"], hot_rows, bucket=4)
    last = defaultdict(dict)
    for i, key, at, value in sorted(log, key=lambda r: r[0]):
        if None not in (key, at, value):
            last[key][at] = value
    expected = []
    for key, values in last.items():
        spans = []
        for at, value in sorted(values.items()):
            if not spans or spans[-1][0] != value:
                spans.append((value, at))
        expected += [(key, v, a, b[1] if b else None) for (v, a), b in zip(spans, [*spans[1:], None], strict=True)]
    assert rows(got) == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])


VISITS = struct("user int, second bigint")


def brute_sessions(visits, gap):
    out = []
    for user in {u for u, s in visits if u is not None}:
        times = sorted(s for u, s in visits if u == user and s is not None)
        for s in times:
            if out and out[-1][0] == user and s - out[-1][2] <= gap:
                out[-1][2:] = [s, out[-1][3] + 1]
            else:
                out.append([user, s, s, 1])
    return sorted(tuple(x) for x in out)


def visits(seed, n=600):
    pick = random.Random(seed)
    return [(pick.choice([1, 1, 1, 2, 3, None]), pick.choice([None, pick.randint(0, 40_000), pick.randint(0, 300) * 100])) for _ in range(n)]


def spans(df):
    return sorted(tuple(r) for r in df.select("user", F.unix_seconds("first_at"), F.unix_seconds("last_at"), "rows").collect())


@pytest.mark.parametrize("gap", [100, 250])
@pytest.mark.parametrize("hot_rows", [None, 5])
def test_sessions(spark, gap, hot_rows):
    log = visits(8)
    df = spark.createDataFrame(log, VISITS).withColumn("at", F.timestamp_seconds("second")).repartition(4)
    for bucket in (50, 1000, 86_400):
        got = sessions(df, ["user"], "at", gap, {"seconds": F.col("second")}, bucket, hot_rows)
        assert spans(got) == brute_sessions(log, gap)
        assert got.agg(F.sum("seconds")).first()[0] == sum(s for u, s in log if None not in (u, s))
    assert sessions(df.limit(0), ["user"], "at", gap).count() == 0
    with pytest.raises(ValueError):
        sessions(df, ["user"], "at", 0)


def test_sessions_of_a_stream(spark, tmp_path):
    log = sorted((v for v in visits(9) if None not in v), key=lambda v: v[1])
    schema = struct("user int, at timestamp")
    for i in range(4):  # in order of time, as a log grows; the last row closes what is open
        part = log[len(log) * i // 4:len(log) * (i + 1) // 4] + ([(99, 10**6)] if i == 3 else [])
        spark.createDataFrame(part, VISITS).select("user", F.timestamp_seconds("second").alias("at")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    found = streamed_sessions(file_stream(spark, f"{tmp_path}/in", schema, "parquet", max_files=1), ["user"], "at", 100, 600)
    found.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out").trigger(availableNow=True).start().awaitTermination()
    assert spans(spark.read.parquet(f"{tmp_path}/out").where("user <> 99")) == brute_sessions(log, 100)


# --- streams ------------------------------------------------------------------


def put(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(map(json.dumps, records)))


def play(i, song="Blue Moon", page="NextSong", user="7"):
    return {"page": page, "ts": 1000 * i, "session_id": 1, "item_in_session": i, "song": song, "artist": "Ann", "length": 200.0, "user_id": user, "level": "free"}


def song(song_id, title="Blue Moon"):
    return {"song_id": song_id, "artist_id": f"A{song_id}", "title": title, "artist_name": "Ann", "duration": 200.0, "num_songs": 1, "year": 2000}


def load(spark, star, root):
    star.load_songs(file_stream(spark, f"{root}/songs", c.STAGING_SONGS.schema, max_files=1))
    star.load_events(file_stream(spark, f"{root}/events", c.STAGING_EVENTS.schema, max_files=1))


def test_first_files_without_keys_plays_or_rows(spark, tmp_path):
    put(tmp_path / "songs/1.json", [song(None)])
    put(tmp_path / "events/1.json", [play(1, page="Home"), play(2, page="Help")])
    put(tmp_path / "events/2.json", [])
    star = StarStream(str(tmp_path / "star"))
    load(spark, star, tmp_path)
    for name in ("songplays", "users", "time", "songs", "artists"):
        assert getattr(star, name)(spark).filter("year >= 0" if name in ("songplays", "songs") else "true").count() in (0, 1), name
    put(tmp_path / "songs/2.json", [song("S1")])
    put(tmp_path / "events/3.json", [play(3)])
    load(spark, star, tmp_path)
    assert [(r.song_id, r.user_id) for r in star.songplays(spark).collect()] == [("S1", 7)]
    assert star.users(spark).count() == star.time(spark).count() == 1


@pytest.mark.parametrize("seed", range(2))
def test_late_songs_complete_facts(spark, tmp_path, seed):
    """Songs and events in any order, no event sent twice; of two songs of one key the smallest wins though it comes last."""
    (tmp_path / "songs").mkdir()
    (tmp_path / "events").mkdir()
    star = StarStream(str(tmp_path / "star"))
    files = [("events/1.json", [play(1), play(2, "Other"), play(3, "None")]), ("songs/1.json", [song("S5")]), ("events/2.json", [play(4), play(5, "Other")]),
             ("songs/2.json", [song("S2"), song("S9", "Other")]), ("songs/3.json", [song("S7")])]
    random.Random(seed).shuffle(files)
    for name, records in files:
        put(tmp_path / name, records)
        load(spark, star, tmp_path)
    found = {int(r["start_time"].timestamp()): (r["song_id"], r["artist_id"]) for r in star.songplays(spark).collect()}
    assert found == {1: ("S2", "AS2"), 2: ("S9", "AS9"), 3: (None, None), 4: ("S2", "AS2"), 5: ("S9", "AS9")}
    all_events = [r for n, rs in files if n.startswith("events") for r in rs]
    all_songs = [r for n, rs in files if n.startswith("songs") for r in rs]
    blank = lambda schema, rs: spark.createDataFrame([{f.name: r.get(f.name) for f in schema} for r in rs], schema)
    batch = c.conform(music.songplays(blank(c.STAGING_EVENTS.schema, all_events), blank(c.STAGING_SONGS.schema, all_songs), ambiguous="first"), c.SONGPLAYS)
    assert rows(star.songplays(spark)) == rows(batch)


def disk_of(root, suffix=""):
    return sum(f.stat().st_size for f in pathlib.Path(root).rglob(f"*{suffix}") if f.is_file())


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in map(files.apply, range(files.size())) if f.getName().endswith(".data")}


def test_a_stream_keeps_its_tables_only(spark, tmp_path):
    """Of 4,000 plays: what is stored of each, and that no shuffle, cached rows or lookups stay behind a batch."""
    plays = [play(i, pick) | {"session_id": i % 40, "last_name": f"Name {i % 9}"} for i, pick in enumerate(["Blue Moon", "Other"] * 2000)]
    for i in range(2):
        put(tmp_path / f"events/{i}.json", plays[i::2])
    put(tmp_path / "songs/1.json", [song("S1"), song("S2", "Other")])
    before = shuffle_files(spark)
    star = StarStream(str(tmp_path / "star"))
    load(spark, star, tmp_path)
    left = {name: size for name, size in shuffle_files(spark).items() if name not in before}
    assert sum(left.values()) < 4 * len(plays)  # names of batches
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    assert not list((tmp_path / "star").rglob("lookups/*/*"))
    assert disk_of(tmp_path / "star/heard", ".parquet") + disk_of(tmp_path / "star/songplays", ".parquet") < 40 * len(plays)
    assert star.songplays(spark).where("song_id IS NOT NULL").count() == len(plays)


def test_a_batch_of_songs_touches_its_plays_only(spark, tmp_path, monkeypatch):
    """Small lookups leave the plays where they are, and plays that meet no song get no second fact."""
    plans = []

    def append(rows, *args, **options):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        append_batch(rows, *args, **options)

    monkeypatch.setattr("lakestar.streaming.star.append_batch", append)
    put(tmp_path / "events/1.json", [play(i) for i in range(50)] + [play(i, "Other") for i in range(50, 60)])
    (tmp_path / "songs").mkdir()
    star = StarStream(str(tmp_path / "star"))
    load(spark, star, tmp_path)
    put(tmp_path / "songs/1.json", [song(None), song("S2", "Other")])
    load(spark, star, tmp_path)
    stored = read_batches(spark, f"{tmp_path}/star/songplays")
    assert stored.groupBy("song_id").count().orderBy("song_id").collect() == [(None, 60), ("S2", 10)]
    assert star.songplays(spark).where("song_id = 'S2'").count() == 10 and star.songplays(spark).count() == 60
    assert len(plans) == 3 and not any("hashpartitioning" in p for p in plans)


def test_events_without_parts_of_their_key(spark, tmp_path):
    """Blank and missing users are one event, and a missing session is one like any other, however often it is sent."""
    events = [play(1, user=""), play(1, user=None), play(1), play(1) | {"session_id": None}, play(1) | {"ts": None}, play(1) | {"item_in_session": None}]
    put(tmp_path / "events/1.json", events)
    put(tmp_path / "events/2.json", events)
    put(tmp_path / "songs/1.json", [song("S1")])
    star = StarStream(str(tmp_path / "star"))
    load(spark, star, tmp_path)
    log = spark.createDataFrame([{f.name: e.get(f.name) for f in c.STAGING_EVENTS.schema} for e in events[1:]], c.STAGING_EVENTS.schema)
    known = spark.createDataFrame([{f.name: song("S1").get(f.name) for f in c.STAGING_SONGS.schema}], c.STAGING_SONGS.schema)
    assert rows(star.songplays(spark)) == rows(c.conform(music.songplays(log, known), c.SONGPLAYS))


def test_arriving_files_are_small_and_whole(spark):
    log = spark.range(5000).select(F.lit("a play like all the others").alias("song"), F.col("id").alias("session_id"))
    root, each = _arrivals(log, "session_id", 4, 2, "event-files")
    names = spark.read.text(root).inputFiles()
    assert 4 <= len(names) and all(n.endswith(".json.gz") for n in names) and each == -(-len(names) // 2)
    assert disk_of(root.removeprefix("file://"), ".json.gz") < 20 * 5000
    assert rows(spark.read.schema(log.schema).json(root)) == rows(log)
