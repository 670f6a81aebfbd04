"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

Indicators, hashed into ``2**BITS`` buckets, of every whole text: words and word pairs, and
one to three word shapes in a row (letters, capitals, digits as one sign each, other signs as
they are; a word that repeats the one before it has a shape of its own). Each indicator is
scaled by the log ratio of its smoothed share in the two classes; a linear hinge-loss model is
fitted on the scaled unit vectors by dual coordinate descent; its margin becomes a probability
by a logistic fit weighted to the class shares of all labelled rows.

The fit sees at most ``per_class`` labelled texts of each class (those with the smallest hash
of their id), a fixed bound, so the model is a table of ``2**BITS`` weights whatever the size of
the corpus. Class counts are taken over all labelled rows, and every text is scored whole.

Results: NULL and empty texts have no indicator and get the score of the bias alone. If the
labels hold no class or one class, every score is that class's share (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.shared import hash_sample, keyed, table
from lakestar.llm.words import GAP, Words, grams, inside, mix, pieces

BITS = 18
PER_CLASS = 3000
THRESHOLD = 0.7
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[ord("a"):ord("z") + 1] = SHAPE[128:] = ord("a")
SHAPE[ord("A"):ord("Z") + 1] = ord("A")
SHAPE[ord("0"):ord("9") + 1] = ord("0")


def shapes(words: Words) -> np.ndarray:
    """A hash of each word's shape: equal signs in a row count as one."""
    sign = SHAPE[words.data]
    fresh = np.ones(len(sign), bool)
    fresh[1:] = sign[1:] != sign[:-1]
    fresh[words.start] = True
    fresh |= GAP[words.data]
    at = np.concatenate([[0], np.cumsum(fresh)])
    return Words(sign[fresh], at[words.bounds]).hashes()


def indicators(words: Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text, and where each text's begin."""
    n = len(words.first) - 1
    hashed = words.hashes()
    owner = words.owner()
    shape = shapes(words)
    again = np.zeros(len(hashed), bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])
    shape[again] ^= np.uint64(0x5851F42D4C957F2D)
    keys = []
    for salt, (values, k) in enumerate(((hashed, 1), (hashed, 2), (shape, 1), (shape, 2), (shape, 3))):
        ok = inside(words.first, k, len(values))
        bucket = mix(grams(values, k)[ok] + np.uint64(salt)) >> np.uint64(64 - bits)
        keys.append((owner[:len(ok)][ok].astype(np.uint64) << np.uint64(bits)) | bucket)
    key = np.unique(np.concatenate(keys))
    return (key & np.uint64((1 << bits) - 1)).astype(np.int64), np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << np.uint64(bits))


@dataclass(frozen=True)
class Model:
    """Weights of the buckets, bias, and the logistic of the margin."""

    weights: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.weights[buckets].astype(np.float64))])
        square = np.concatenate([[0.0], np.cumsum(np.square(self.ratio[buckets].astype(np.float64)))])
        size = np.sqrt(np.maximum(square[bounds[1:]] - square[bounds[:-1]], 1e-12))
        return (total[bounds[1:]] - total[bounds[:-1]]) / size + self.bias

    def scores(self, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(buckets, bounds) + self.offset, -40, 40)))


def coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, cost: np.ndarray, width: int, rounds: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L2-regularised hinge loss; the bias is one more constant indicator."""
    w, bias, alpha = np.zeros(width), 0.0, np.zeros(len(rows))
    norm = np.array([v @ v + 1 for v in values])
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            x, v = rows[i], values[i]
            slope = sign[i] * (w[x] @ v + bias) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[x] += step * v
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def logistic(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit by Newton steps with a small ridge."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        g = weight * (p - label)
        h = weight * p * (1 - p) + 1e-9
        grad = np.array([g @ margin + 1e-3 * a, g.sum()])
        curve = np.array([[h @ margin**2 + 1e-3, h @ margin], [h @ margin, h.sum() + 1e-6]])
        step = np.linalg.solve(curve, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def fit(rows: list[np.ndarray], labels: np.ndarray, share: float, bits: int = BITS, cost: float = 1.0, blend: float = 0.25, rounds: int = 30) -> Model:
    """A model from the indicators of some labelled texts; ``share`` is the share of label 1 among all labelled rows."""
    width = 1 << bits
    flat = np.zeros(width, np.float32)
    good = labels == 1
    if not good.any() or good.all():
        rate = min(max(share, 0.0), 1.0) if len(labels) else 0.5
        return Model(flat, flat, 0.0, 1.0, float(np.log((rate + 1e-9) / (1 - rate + 1e-9))))
    counts = np.zeros((2, width))
    for row, label in zip(rows, good, strict=True):
        counts[int(label), row] += 1
    ratio = np.log((counts[1] + 1) / (good.sum() + 2)) - np.log((counts[0] + 1) / ((~good).sum() + 2))
    values = [ratio[r] / max(np.sqrt(np.square(ratio[r]).sum()), 1e-6) for r in rows]
    sign = np.where(good, 1.0, -1.0)
    w, bias = coordinate_descent(rows, values, sign, np.full(len(rows), cost), width, rounds)
    w = (1 - blend) * np.abs(w).mean() + blend * w if blend < 1 else w
    model = Model((w * ratio).astype(np.float32), ratio.astype(np.float32), bias * (blend if blend < 1 else 1), 1.0, 0.0)
    flat_rows, bounds = np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    weight = np.where(good, share / good.mean(), (1 - share) / (1 - good.mean()))
    slope, offset = logistic(model.margins(flat_rows, bounds), good.astype(float), weight)
    return Model(model.weights, model.ratio, model.bias, slope, offset)


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def buckets_of(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, _, words in pieces(batch.column("text")):
                buckets, bounds = indicators(words, bits)
                rows += [buckets[a:b].astype("<i4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "buckets"])
    return run


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, bits: int = BITS, **options) -> Model:
    """Fit on rows of ``labels (doc_id, quality)`` that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).groupBy("doc_id").agg(F.max("label").alias("label"))
    count = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = [hash_sample(known.where(F.col("label") == k), ["doc_id"], per_class, count.get(k, 0)) for k in (0, 1)]
    wanted = F.broadcast(picked[0].union(picked[1]))  # at most two times per_class rows
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(wanted, "doc_id")
    rows = sorted({tuple(r) for r in found.mapInArrow(buckets_of(bits), "doc_id long, label int, buckets binary").toLocalIterator()})
    total = sum(count.values())
    return fit(
        [np.frombuffer(r[2], "<i4").astype(np.int64) for r in rows], np.array([r[1] for r in rows], np.int64),
        count.get(1, 0) / total if total else 0.5, bits, **options)


def score(docs: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """doc_id and score of every row; with ``carry`` also its text and ``doc``, see ``keyed``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two tables of 2**BITS numbers
    texts = keyed(docs, carry).drop("text_key")
    kept = ["doc_id", "text", "doc"] if carry else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        bits = int(np.log2(len(own.weights)))
        for batch in batches:
            parts = [own.scores(*indicators(words, bits)) for _, _, words in pieces(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(np.concatenate(parts) if parts else np.zeros(0))], [*kept, "score"])

    return texts.mapInArrow(run, texts.select(*kept).withColumn("score", F.lit(0.0)).schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row."""
    return score(docs, train(docs, labels, **options)).select(
        "doc_id", is_held_out().alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
