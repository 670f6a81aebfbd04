"""Registered text queries against SQL, and the pipeline stage by stage."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
import oracle
from brute import dropped_lines, jaccard_rows, shingles, words
from frames import frame  # noqa: F401
from lakestar.llm.piece_trie import MODEL_FILE, Encoder, PieceModel
from lakestar.llm.quality_model import THRESHOLD, score, train
from lakestar.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert not oracle.compare(name, df, duck, ORACLES[name])
    elif name.startswith(("op5", "op7", "op10", "op11")):
        assert df.count() == 200


def test_stages(spark, tmp_path):
    """Every stage on what the one before kept, held against plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = f"{tmp_path}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        rows[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name == "piece ids":
            break
        assert out.columns == columns, name
        docs = spark.read.parquet(path)
    ran = spark.read.parquet(path)

    first = spark.read.parquet(f"{SF}/documents.parquet")
    model = train(first, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r["doc_id"] for r in score(first, model).collect() if r["score"] >= THRESHOLD}
    assert sorted(i for i, _ in rows["line dedup"]) == sorted(i for i, _ in rows["quality classifier"] if i in good)

    expected = [(i, t) for i, _, n, t in dropped_lines(rows["line dedup"]) if not n or t.strip(" ")]
    assert sorted(rows["n-gram Jaccard join"]) == sorted(expected)

    keep = {i for i, n, c in jaccard_rows(rows["n-gram Jaccard join"], 5, (80, 100)) if i == c or not n}
    assert sorted(rows["source mix"]) == sorted(r for r in rows["n-gram Jaccard join"] if r[0] in keep)

    times = Counter(i for i, _ in rows["piece ids"])
    assert max(times.values()) <= 3 and set(rows["piece ids"]) <= set(rows["source mix"])
    size = sum(len(words(t)) for _, t in rows["source mix"])
    assert abs(sum(len(words(t)) for _, t in rows["piece ids"]) - size) <= 0.2 * size

    with open(MODEL_FILE, "rb") as f:
        own = Encoder(PieceModel.read(f.read()))
    encoded = [(r["doc_id"], r["piece_ids"]) for r in ran.collect()]
    wanted = [(i, np.frombuffer(own.encode([t])[0], "<i4").tolist()) for i, t in rows["piece ids"]]
    assert sorted(encoded) == sorted(wanted)


def test_pipeline_runs(spark):
    assert {"doc_id", "piece_ids"} <= set(corpus_pipeline.run(spark, SF).columns)


@pytest.mark.parametrize("rows", [[], [(1, None), (1, None), (None, "a b c"), (2, ""), (3, "x " * 60), (3, "x " * 60), (4, "one\ntwo")]])
def test_stages_on_odd_rows(spark, frame, rows):
    docs = frame(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        found = out.collect()
        if name != "piece ids":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(found, docs.schema)


def test_near_copies_on_five_words(spark, frame):
    """Against a brute force of five words and 0.8; some pairs are below 0.9 on three words."""
    pick = random.Random(8)
    docs = []
    for i in range(12):
        base = [f"w{pick.randint(0, 400)}" for _ in range(120)]
        docs.append((10 * i, " ".join(base)))
        for j in range(1, 4):
            copy = list(base)
            for _ in range(j):
                copy[pick.randint(0, 119)] = f"v{pick.randint(0, 99)}"
            docs.append((10 * i + j, " ".join(copy)))
    docs += [(500, None), (501, ""), (502, "two words"), (503, "two words")]

    def kept(k, share):
        sets = [shingles(t, k) for _, t in docs]
        name = {i: i for i, _ in docs}
        for (i, _), x in zip(docs, sets, strict=True):
            for (j, _), y in zip(docs, sets, strict=True):
                if x and y and len(x & y) >= share * len(x | y) and name[i] != name[j]:
                    low, high = sorted((name[i], name[j]))
                    name = {d: low if n == high else n for d, n in name.items()}
        return sorted(d for d, n in name.items() if d == n)

    got = sorted(r["doc_id"] for r in corpus_pipeline.near_copies(spark, frame(docs), SF).collect())
    assert got == kept(5, 0.8) != kept(3, 0.9)


def test_everything_is_registered():
    import __spark_entry__ as entry

    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in entry.queries() if n.startswith("op") and n[2].isdigit()}
    assert "pipeline" in entry.queries()
