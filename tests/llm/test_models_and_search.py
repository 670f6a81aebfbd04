"""Classifier, piece encoder and vector search."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brute import top_k as brute_top_k
from frames import frame  # noqa: F401
from lakestar.llm import topk_search
from lakestar.llm.piece_trie import BPE, MODEL_FILE, UNIGRAM, Encoder, PieceModel, decode, encode, proto_fields, round_trip
from lakestar.llm.quality_model import classify, is_held_out, score, train
from lakestar.llm.topk_search import top_k

SF = "/root/testdata/sf0.01"


def vectors(spark, rows, extra=True):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType())])
    return spark.createDataFrame([(i, v, "q") for i, v in rows], schema)


@pytest.mark.parametrize("leaf_sample", [4, 64])
def test_top_k(spark, monkeypatch, leaf_sample):
    monkeypatch.setattr(topk_search, "LEAF_SAMPLE", leaf_sample)
    monkeypatch.setattr(topk_search, "BLOCK", 16)
    pick = np.random.default_rng(leaf_sample)
    centres = pick.normal(size=(5, 6))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + 0.1 * pick.normal(size=6)]) for i in range(200)]
    rows += [(300 + i, rows[0][1]) for i in range(8)]  # ties
    rows += [(400, None), (401, [1.0, None] + [0.0] * 4), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, rows[1][1])]
    rows += [rows[3], (450, [2.0, 1.0]), (500, [3e9] * 6), (501, [-3e9] * 6)]
    got = sorted(tuple(r) for r in top_k(vectors(spark, rows), k=5, every=10).collect())
    assert got == sorted(brute_top_k(rows, 5, 10))


def test_top_k_of_few(spark):
    assert top_k(vectors(spark, [])).count() == 0
    assert top_k(vectors(spark, [(1, [1.0, 2.0])])).count() == 0
    assert [tuple(r) for r in top_k(vectors(spark, [(0, [1.0]), (7, [0.5])])).collect()] == [(0, 1, 7, 256 * 128)]


def test_far_nodes_are_pruned():
    """Groups of far clusters meet no leaf of the other clusters."""
    pick = np.random.default_rng(0)
    points = np.concatenate([1000 * np.eye(4)[i] + pick.normal(size=(50, 4)) for i in range(4)])
    leaves = []
    root = topk_search.build(points, leaves)
    out = np.zeros(len(points), np.int64)
    topk_search.descend(root, points, np.arange(len(points)), out)
    stats = {int(x): (float(np.linalg.norm(points[out == x] - leaves[x], axis=1).max()),) for x in np.unique(out)}
    groups = {x: (leaves[x], s[0], 900_000.0) for x, s in stats.items()}
    pairs = topk_search.walk(root, stats, groups)
    assert {(a, b) for a, b in pairs if leaves[a].argmax() != leaves[b].argmax()} == set()
    assert {(x, x) for x in groups} <= set(pairs)


def test_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = [r["predicted"] == r["quality"] for r in rows]
    assert len(rows) > 50 and sum(right) >= 0.95 * len(rows)
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    assert sum(good) >= 0.97 * len(good)


def test_held_out_labels_are_not_learned(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = train(docs, labels), train(docs.repartition(5), turned)
    assert np.array_equal(a.weights, b.weights)


def test_classifier_without_two_classes(spark, frame):
    docs = frame([(1, None), (1, None), (2, ""), (3, "some words here"), (None, "x")])
    for rows, expected in (([], 0.5), ([(1, 1, 0), (3, 1, 0)], 1.0), ([(1, 0, 0), (3, 0, 1)], 0.0), ([(1, None, None), (None, 1, 1)], 0.5)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        scores = [r["score"] for r in classify(docs, labels).collect()]
        assert len(scores) == 5 and scores == pytest.approx([expected] * 5, abs=1e-6)
    assert classify(frame([]), spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    model = train(docs, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int"))
    assert all(0 <= r["score"] <= 1 for r in score(docs, model).collect())


def as_unigram(data: bytes) -> bytes:
    """The model with its method switched to unigram: the same pieces and scores."""
    out, at = bytearray(data), 0

    def varint(at):
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value, at

    while at < len(data):
        tag, at = varint(at)
        size, at = varint(at)
        if tag >> 3 == 2:
            inner = at
            while inner < at + size:
                key, value = varint(inner)
                if key >> 3 == 3:
                    out[value] = UNIGRAM
                    return bytes(out)
                inner = varint(value)[1] if key & 7 == 0 else value + 4 if key & 7 == 5 else sum(varint(value)[:2])
        at += size
    raise AssertionError


TEXTS = ["Hello  world\n a\tb", "", " ", "  x", "é a\x00b", "\xa0a a", "x" * 300, "a\r\nb", "    def f(x):\n        return  1\n\n\n", "日本語テキスト😀 梦",
         "​zero‍width", "1234567890 " * 5, " \n \n", "tab\t\tend ", "ﬁ ligature Ⅷ", "the" * 50 + " " * 40 + "x", "naïve coöperation, Straße"]


@pytest.fixture(scope="module")
def model_file():
    with open(MODEL_FILE, "rb") as f:
        return f.read()


def test_bpe_ids_are_the_librarys(model_file):
    own, library = Encoder(PieceModel.read(model_file)), sentencepiece.SentencePieceProcessor(model_proto=model_file)
    assert own.model.method == BPE
    pick = random.Random(0)
    texts = TEXTS + ["".join(pick.choice("abcdefgh  the\n\t.,0123éß#") for _ in range(pick.randint(0, 40))) for _ in range(2000)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(text), text
        assert own.decode(ids) == text


def test_unigram_scores_are_the_librarys(model_file):
    data = as_unigram(model_file)
    own, library = Encoder(PieceModel.read(data)), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert own.model.method == UNIGRAM

    def total(ids):
        return sum(own.model.scores[i] for i in ids)

    for text, ids in zip(TEXTS, own.encode(TEXTS), strict=True):
        mine, theirs = np.frombuffer(ids, "<i4").tolist(), library.encode(text)
        assert mine == theirs or total(mine) == pytest.approx(total(theirs), rel=1e-6), text


def test_prefixes_are_shared_without_harm(model_file):
    own, fresh = Encoder(PieceModel.read(model_file)), Encoder(PieceModel.read(model_file))
    words = sorted({"▁" + "abab"[:i % 5] + "theing"[:i % 7] + "er" * (i % 3) for i in range(200)})
    walked = dict(own.encode_sorted(words))
    assert all(dict(fresh.encode_sorted([w]))[w] == ids for w, ids in walked.items())


def test_encode_and_decode_tables(spark, frame):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (100, None), (None, "x"), (101, "word " * 50_000)]
    encoded = encode(frame(rows))
    assert set(encoded.columns) == {*frame(rows).columns, "piece_ids"} - {"text"}
    back = sorted(((r["doc_id"], r["text"]) for r in decode(encoded).collect()), key=repr)
    assert back == sorted(rows, key=repr)
    trip = round_trip(frame(rows)).collect()
    assert len(trip) == len(rows) and all(r["same_text"] in (True, None) or r["text_sha256"] is None for r in trip)
    assert encode(frame([])).count() == 0 and round_trip(frame([])).count() == 0


def test_proto_fields():
    assert list(proto_fields(b"\x08\x96\x01\x12\x02hi\x1d\x00\x00\x80\x3f")) == [(1, 150), (2, b"hi"), (3, b"\x00\x00\x80\x3f")]
