"""Importance resampling towards a target corpus, on hashed n-grams.

Features are all runs of 1 to ``n`` words of a text, joined by one space; a feature's bucket is its CRC-32 modulo
``buckets``. A bucket's gain is the log ratio of its (smoothed) share in the target and in the corpus, a document's weight the
mean gain of its features. Gumbel noise from a keyed hash of the id is added, and the highest scores are drawn: sampling
without replacement in proportion to the exponential of the weights.

Each text is scanned once, as its words with one space between them, and the running CRC is stored at both ends of every
word. The CRC of the bytes between two places is the later CRC xor the earlier one shifted by the bytes between them: a multiplication by a
power of x over GF(2), which cancels all that stands before. So an n-gram costs one shift, however
long it is, and no n-gram is ever built. Texts of a batch are scanned in one stream, for what stands before does not count.

Counts go to the driver as one row a bucket. Ranks: counts per score (whole numbers within a fixed range, so few values)
give each score its first rank; within a score, documents are ordered by id. Results: NULL text and text without words have no
features and weight 0; a NULL id draws as an empty id and comes after any id. Repeats count each and have ranks of their own. No document, no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.llm.shared import keyed, saved, table
from lakestar.llm.words import strings, word_runs

N = 2
BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 25
SEED = "7"
SCALE = 1000
RUN_BYTES = 1 << 20
#: Lower-case letters for A-Z; digits, a-z and all bytes beyond ASCII as they are; a blank for the rest.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
NEAR = 64


def byte_step() -> np.ndarray:
    """What a zero byte does to a CRC whose last byte is v, for each v."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


def applied(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its values for each byte at each of four places."""
    return tables[0][c & 255] ^ tables[1][(c >> 8) & 255] ^ tables[2][(c >> 16) & 255] ^ tables[3][c >> 24]


class Shift:
    """CRCs shifted by any number of zero bytes."""

    def __init__(self):
        self.step = byte_step()
        v = np.arange(256, dtype=np.uint32)
        one = np.stack([self.step, *(v << np.uint32(8 * place - 8) for place in (1, 2, 3))])
        near = [np.stack([v << np.uint32(8 * place) for place in range(4)])]
        for _ in range(NEAR):
            near.append(applied(one, near[-1]))
        self.near = np.stack(near[:NEAR]).reshape(-1)
        self.far = [near[NEAR]]  # by NEAR * 2 ** i
        for _ in range(26):
            self.far.append(applied(self.far[-1], self.far[-1]))

    def __call__(self, c: np.ndarray, length: np.ndarray) -> np.ndarray:
        at = (length % NEAR) << 10
        out = (self.near[at + (c & 255)] ^ self.near[at + 256 + ((c >> 8) & 255)]
               ^ self.near[at + 512 + ((c >> 16) & 255)] ^ self.near[at + 768 + (c >> 24)])
        rest = length // NEAR
        for tables in self.far:
            if not rest.any():
                break
            odd = (rest & 1).astype(bool)
            out[odd] = applied(tables, out[odd])
            rest = rest >> 1
        return out

    def blank(self, c: np.ndarray) -> np.ndarray:
        """CRCs with one more space."""
        c = ~c
        return ~(self.step[(c ^ np.uint32(32)) & np.uint32(255)] ^ (c >> np.uint32(8)))


def streamed(column: pa.Array) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Normalised words of the texts with their rows, about ``RUN_BYTES`` at a time."""
    data, bounds = strings(column)
    words: list[bytes] = []
    rows: list[int] = []
    counts: list[int] = []
    size = 0
    for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        for run in word_runs(data[a:b].tobytes().translate(NORMAL), RUN_BYTES):
            words += run
            rows.append(row)
            counts.append(len(run))
        size += b - a
        if size >= RUN_BYTES and words:
            yield words, np.repeat(rows, counts)
            words, rows, counts, size = [], [], [], 0
    if words:
        yield words, np.repeat(rows, counts)


def features(column: pa.Array, n: int, buckets: int, shift: Shift) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(bucket, row)`` of features and the row of each word, a run of words at a time."""
    last, begin, end, long, owner = 0, *(np.zeros(0, t) for t in (np.uint32, np.uint32, np.int64, np.int64))
    for words, rows in streamed(column):
        after = np.fromiter(accumulate(words, lambda c, w: zlib.crc32(w, zlib.crc32(b" ", c)), initial=last), np.uint32, len(words) + 1)
        last = int(after[-1])
        # The last n - 1 words of the run before may go on in this one.
        old = len(end)
        begin, end = np.concatenate([begin, shift.blank(after[:-1])]), np.concatenate([end, after[1:]])
        long = np.concatenate([long, np.fromiter(map(len, words), np.int64, len(words))])
        owner = np.concatenate([owner, rows])
        bounds = np.concatenate([[0], np.cumsum(long + 1)])
        buckets_, rows_ = [], []
        for m in range(1, n + 1):
            ends = np.arange(max(old, m - 1), len(end))
            starts = ends - m + 1
            whole = owner[starts] == owner[ends]
            starts, ends = starts[whole], ends[whole]
            crc = end[ends] ^ shift(begin[starts], bounds[ends + 1] - 1 - bounds[starts])
            buckets_.append(crc % np.uint32(buckets))
            rows_.append(owner[ends])
        yield np.concatenate(buckets_).astype(np.int64), np.concatenate(rows_), rows
        begin, end, long, owner = (x[max(0, len(x) - n + 1):] for x in (begin, end, long, owner))


def bucket_counts(texts: DataFrame, column: str, n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, features)`` over all texts; a task sends one row a bucket at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shift = np.zeros(buckets, np.int64), Shift()
        for batch in batches:
            for bucket, _, _ in features(batch.column(0), n, buckets, shift):
                counts += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], ["bucket", "features"])
    return texts.select(F.col(column).cast("string")).mapInArrow(run, "bucket int, features long").groupBy("bucket").agg(F.sum("features").alias("features"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket, from the counts of both sides; ``buckets`` numbers."""
    spark = corpus.sparkSession
    both = (
        spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(corpus.withColumnRenamed("features", "s"), "bucket", "left").join(target.withColumnRenamed("features", "t"), "bucket", "left")
        .select("bucket", *(F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st")))
    totals = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = ((F.col("t") + 1) * (F.col("all_s") + buckets)) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    rows = both.crossJoin(F.broadcast(totals)).select("bucket", F.floor(SCALE * F.log(ratio)).alias("gain")).collect()  # one row each bucket
    return [gain for _, gain in sorted(map(tuple, rows))]


def weighed(docs: DataFrame, gain: list[int], n: int = N, seed: str = SEED) -> DataFrame:
    """doc_id, text_key, n_words, n_features, weight and score: a row per document."""
    docs = keyed(docs)
    shared = docs.sparkSession.sparkContext.broadcast(np.array(gain, np.float64))  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, gain = Shift(), shared.value
        for batch in batches:
            size = batch.num_rows
            n_words, n_features, total = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size)
            for bucket, row, word_row in features(batch.column("text"), n, len(gain), shift):
                n_words += np.bincount(word_row, minlength=size)
                n_features += np.bincount(row, minlength=size)
                total += np.bincount(row, gain[bucket], minlength=size)
            weight = total.astype(np.int64) // np.maximum(n_features, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), *map(pa.array, (n_words, n_features, weight))],
                ["doc_id", "text_key", "n_words", "n_features", "weight"])

    rows = docs.mapInArrow(run, "doc_id long, text_key long, n_words long, n_features long, weight long")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(float(2**32))
    noise = F.floor(-SCALE * F.log(-F.log(share)))
    return rows.withColumn("score", F.col("weight") + noise)


def ranked(rows: DataFrame, least_words: int = LEAST_WORDS, share: int = SHARE) -> DataFrame:
    """The rows with ``rank``: 1 for the highest score on, as far as the draw goes; NULL for those not drawn.

    Draws ``share`` percent of the rows with ``least_words`` words, rounded down.
    """
    able = F.col("n_words") >= least_words
    per_score = rows.where(able).groupBy("score").agg(F.count("*").alias("size"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = per_score.select(
        "score", F.coalesce(F.sum("size").over(above), F.lit(0)).alias("before"), F.floor(F.lit(share) * F.sum("size").over(every) / 100).alias("size")
    ).where("before < size")
    within = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "text_key")
    chosen = rows.where(able).join(F.broadcast(starts), "score").withColumn("place", F.col("before") + F.row_number().over(within))
    rank = F.when(F.col("place") <= F.col("size"), F.col("place"))
    others = rows.where(F.coalesce(~able, F.lit(True))).withColumn("rank", F.lit(None).cast("long"))
    below = rows.where(able).join(F.broadcast(starts.select("score")), "score", "left_anti").withColumn("rank", F.lit(None).cast("long"))
    return chosen.select(*rows.columns, rank.alias("rank")).unionByName(others).unionByName(below)


def resampled(docs: DataFrame, target: DataFrame, target_column: str = "text", share: int = SHARE) -> DataFrame:
    """doc_id, text_key, n_words, n_features, weight, score and rank: a row per document."""
    gain = gains(bucket_counts(docs, "text"), bucket_counts(target, target_column))
    return ranked(saved(weighed(docs, gain), "importance-scores"), share=share)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = rf"""
WITH step AS MATERIALIZED (
  SELECT list_transform(range(256), lambda v: list_reduce([CAST(v AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END)) AS t),
text AS (
  SELECT true AS doc, doc_id AS id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark),
w AS (
  SELECT doc, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM text),
f AS (
  SELECT doc, id, unnest(w) AS f FROM w
  UNION ALL SELECT doc, id, w[i] || ' ' || w[i + 1] FROM w, unnest(range(1, len(w))) AS r(i)),
n AS (SELECT doc, id, f, count(*) AS n FROM f GROUP BY ALL),
hex AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM n)),
crc AS (
  SELECT f, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(h), 2),
      lambda i: CAST(16 * (strpos('0123456789ABCDEF', h[i:i]) - 1) + strpos('0123456789ABCDEF', h[i + 1:i + 1]) - 1 AS BIGINT))),
    lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)])), CAST(4294967295 AS BIGINT)) % {BUCKETS} AS bucket
  FROM hex, step),
side AS (
  SELECT bucket, sum(CASE WHEN doc THEN n ELSE 0 END) AS s, sum(CASE WHEN doc THEN 0 ELSE n END) AS t FROM n JOIN crc USING (f) GROUP BY bucket),
total AS (SELECT CAST(sum(s) AS DOUBLE) AS all_s, CAST(sum(t) AS DOUBLE) AS all_t FROM side),
gain AS (
  SELECT bucket, CAST(floor({SCALE} * ln(((t + 1) * (all_s + {BUCKETS})) / ((s + 1) * (all_t + {BUCKETS})))) AS BIGINT) AS gain FROM side, total),
weight AS (
  SELECT id, sum(n) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight
  FROM n JOIN crc USING (f) JOIN gain USING (bucket) WHERE doc GROUP BY id),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-{SCALE} * ln(-ln((CAST('0x' || sha256('{SEED}:' || CAST(id AS VARCHAR))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN weight USING (id) WHERE doc),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {SHARE} * n // 100 THEN rank END AS rank FROM scored LEFT JOIN drawn USING (doc_id)
"""
