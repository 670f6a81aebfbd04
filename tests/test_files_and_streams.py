import gzip
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakestar import contracts as c
from lakestar.session import work_dir
from lakestar.sources import files, sinks
from lakestar.streaming.incremental import DeltaLog, append_batch, file_stream, ingest_available, read_batches

RAW = {"artist": "Trio", "firstName": "Ann", "sessionId": 5, "itemInSession": 1, "ts": 7, "page": "NextSong", "extra": 1}


def put(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_json_tree_and_field_paths(spark, tmp_path):
    put(tmp_path / "2018/11/a.json", [json.dumps(RAW)])
    put(tmp_path / "2018/12/b.json", [json.dumps({**RAW, "ts": 8, "userId": "4"})])
    put(tmp_path / "2018/12/notes.txt", ["no json"])
    got = files.read_json_paths(spark, f"{tmp_path}/*/*/*.json", c.EVENT_PATHS, c.STAGING_EVENTS)
    assert got.columns == c.STAGING_EVENTS.columns
    assert sorted((r.first_name, r.session_id, r.ts, r.user_id or "") for r in got.collect()) == [
        ("Ann", 5, 7, ""), ("Ann", 5, 8, "4")]
    tree = files.read_json(spark, str(tmp_path), tree=True, glob="*.json")
    assert tree.count() == 2 and "extra" in tree.columns


def test_nested_paths(spark, tmp_path):
    put(tmp_path / "p.json", ['{"data": {"title": "x", "author": "y", "n": 1}, "other": 2}'])
    contract = c.Contract("posts", c.struct("title string, author string"))
    got = files.read_json_paths(spark, str(tmp_path), {"title": "data.title", "author": "data.author"}, contract)
    assert rows(got) == [("x", "y")]


def test_csv_forms(spark, tmp_path):
    put(tmp_path / "a/p.csv", ["payment_id;amount;payment_date", "1;2.5;2007-01-24", "2;3.0;2007-02-01"])
    declared = files.read_csv(spark, str(tmp_path / "a"), c.struct("payment_id int, amount double, payment_date date"), sep=";")
    assert declared.agg(F.sum("amount")).first()[0] == 5.5
    assert dict(files.read_csv(spark, str(tmp_path / "a"), sep=";", infer=True).dtypes)["amount"] == "double"
    assert files.read_csv(spark, str(tmp_path / "a"), header=False).columns == ["_c0"]
    df = spark.createDataFrame([(1, 'say "hi",\nthere \\ "'), (2, None)], "k int, t string")
    sinks.write_csv(df, str(tmp_path / "out"), quote_all=True)
    assert rows(files.read_csv(spark, str(tmp_path / "out"), df.schema, multi_line=True)) == rows(df)


def test_all_directories_are_read_and_headers_skipped(spark, tmp_path):
    put(tmp_path / "d1/a.csv", ["artist,n", "A,1"])
    put(tmp_path / "d2/b.csv", ["artist,n", "B,2"])
    got = files.read_csv(spark, str(tmp_path), c.struct("artist string, n int"), tree=True)
    assert rows(got) == [("A", 1), ("B", 2)]


def test_gzip_text(spark, tmp_path):
    with gzip.open(tmp_path / "x.gz", "wt") as f:
        f.write("one\ntwo\n")
    got = files.read_text(spark, str(tmp_path / "x.gz"), partitions=3)
    assert rows(got) == [("one",), ("two",)] and got.rdd.getNumPartitions() == 3


def test_partition_values_keep_their_type(spark, tmp_path):
    contract = c.Contract("t", c.struct("v int, code string"), partition_by=("code",))
    df = spark.createDataFrame([(1, "007"), (2, "7"), (3, None)], contract.schema)
    sinks.write_table(df, contract, str(tmp_path / "t"))
    read = files.read_table(spark, str(tmp_path / "t"), contract)
    assert rows(read) == rows(df)
    pruned = read.filter("code = '007'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in pruned
    assert len(read.filter("code = '007'").inputFiles()) <= len(read.inputFiles())
    odd = spark.createDataFrame([(1, ""), (2, None), (3, "\\"), (4, "\\x")], contract.schema)
    sinks.write_table(odd, contract, str(tmp_path / "odd"))
    assert rows(files.read_table(spark, str(tmp_path / "odd"), contract)) == rows(odd)


def test_clustered_write_is_sorted_and_splits_a_hot_leading_key(spark, tmp_path):
    contract = c.Contract("t", c.struct("user int, item int"), key=("user", "item"))
    df = spark.range(1000).select(F.lit(1).alias("user"), F.col("id").cast("int").alias("item")).repartition(4)
    sinks.write_clustered(df, contract, str(tmp_path / "t"), partitions=4)
    read = spark.read.parquet(str(tmp_path / "t"))
    spans = read.groupBy(F.input_file_name()).agg(F.min("item").alias("lo"), F.max("item").alias("hi")).orderBy("lo").collect()
    assert len(spans) == 4 and all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_staging_appends(spark, tmp_path):
    df = spark.createDataFrame([("1", "x")], "song_id string, title string")
    files.stage(df, c.STAGING_SONGS, str(tmp_path / "s"))
    assert files.stage(df, c.STAGING_SONGS, str(tmp_path / "s"), "append").count() == 2
    assert files.stage(df, c.STAGING_SONGS, str(tmp_path / "s")).count() == 1


def test_work_dir_is_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one != two and (base is None or one.startswith(base))


SCHEMA = c.struct("user_id int, name string, level string, ts int")


def visit(user, name, level, ts):
    return json.dumps(dict(user_id=user, name=name, level=level, ts=ts))


def users_log(root):
    return DeltaLog(str(root), ("user_id",), ("ts",), ("name",), ("level",))


def test_incremental_ingestion(spark, tmp_path):
    log = users_log(tmp_path / "users")
    (tmp_path / "in").mkdir()
    stream = file_stream(spark, str(tmp_path / "in"), SCHEMA, max_files=1, glob="*.json")
    batches = []

    def handle(df, batch):
        batches.append(batch)
        log.append(df, batch)
        append_batch(df, str(tmp_path / "facts"), batch)

    put(tmp_path / "in/a/1.json", [visit(1, "Ann", "free", 10), visit(2, "Bo", "free", 11)])
    put(tmp_path / "in/b/2.json", [visit(1, "Anna", "paid", 30)])
    put(tmp_path / "in/b/3.json", [visit(1, "Ane", "free", 20)])  # older than the file before it
    ingest_available(stream, str(tmp_path / "cp"), handle)
    assert len(batches) == 3
    assert rows(log.read(spark)) == [(1, "Ann", "paid"), (2, "Bo", "free")]
    ingest_available(stream, str(tmp_path / "cp"), handle)
    assert len(batches) == 3  # nothing new, nothing done
    put(tmp_path / "in/b/4.json", [visit(3, "Cy", "paid", 5)])
    ingest_available(stream, str(tmp_path / "cp"), handle)
    assert len(batches) == 4 and log.read(spark).count() == 3
    assert read_batches(spark, str(tmp_path / "facts")).count() == 5
    before = rows(log.read(spark))
    ingest_available(stream, str(tmp_path / "cp2"), log.append)  # all files again, under a new checkpoint
    assert rows(log.read(spark)) == before
    log.fold(spark)
    assert rows(log.read(spark)) == before and len(log._open(spark)) == 1
    log.append(spark.createDataFrame([(9, "Di", "free", 1)], SCHEMA), "later")
    assert log.read(spark).count() == len(before) + 1


def test_replayed_batch_replaces_itself(spark, tmp_path):
    log = users_log(tmp_path / "users")
    df = spark.createDataFrame([(1, "Ann", "free", 10), (1, "Ann", "paid", 20)], SCHEMA)
    for _ in range(2):
        log.append(df, "0")
        append_batch(df, str(tmp_path / "facts"), "0")
    log.append(df, "1")
    other = spark.createDataFrame([(3, "Cy", "free", 1)], SCHEMA)
    for batch in ("2", "3", "4"):
        log.append(other, batch, fold_every=2)
    assert rows(log.read(spark)) == [(1, "Ann", "paid"), (3, "Cy", "free")]
    assert len(log._open(spark)) <= 3
    assert read_batches(spark, str(tmp_path / "facts")).count() == 2


def test_views(spark):
    sinks.register_views({"seen_users": spark.createDataFrame([(1, "x")], "k int, v string")})
    assert spark.sql("SELECT v FROM seen_users").first().v == "x"


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "yarn"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        work_dir(Session(), "x")
