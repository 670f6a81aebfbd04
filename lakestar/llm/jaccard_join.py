"""Exact n-gram Jaccard join by rare-first prefix filtering, and its connected components.

Texts with equal shingle sets form a class and are joined once, through one representative.
Shingles are 64-bit hashes in one global order, rare first: by the count of their hash bucket
(``2**COUNT_BITS`` counters over all texts, a table of fixed size), then by hash. If two sets
reach the threshold, their prefixes share a shingle.

1. Classes are joined on the shingles of their prefixes. In every group the most central class
   (the one with the most common shingles) is paired with each other one. Length and positional
   filters apply, then the two whole prefixes bound the overlap, then a suffix filter and the
   exact sets decide, once per pair.
2. Groups that lie in one component now hold nothing new. In the rest, pairs of classes from
   different components are joined under the same filters and verified alike. So no link
   between components is missed, and no group is expanded into all its pairs.

A group with many rows is split: in step 1 by salting (its bucket count tells how far), in step
2 it is a plain equi-join, which adaptive execution splits. Results: NULL text and text
without words have an empty set and are linked with nothing; a text of fewer than ``k`` words
has one shingle. Rows are known by id and text, repeats are copies. A component is named by its
smallest id; NULL ids count as larger than any and name a component only if it has no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.shared import components, keyed, same_row, saved, table
from lakestar.llm.words import BASE, Words, grams, mix, pieces

SHINGLE = 3
SHARE = (90, 100)
COUNT_BITS = 20
CHUNK = 4096
GROUP_ROWS = 20_000


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashed = words.hashes()
    mers = grams(hashed, k)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(mers[a:b - k + 1]))
        elif b > a:
            whole = b - a
            for h in hashed[a:b].tolist():
                whole = (whole * BASE + h) % 2**64
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def count_buckets(k: int):
    """Counters of a task, a row for each run of ``CHUNK`` buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for _, _, words in pieces(batch.column("text"), lower=True):
                counts += np.bincount(bucket(np.concatenate(shingle_sets(words, k))), minlength=len(counts))
        rows = counts.reshape(-1, CHUNK)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([rows[i].astype("<i8").tobytes() for i in used], pa.binary())], ["chunk", "counts"])
    return run


def add_counts(key, batches):
    total = sum(np.frombuffer(x, "<i8") for x in batches["counts"])
    return pd.DataFrame({"chunk": [key[0]], "counts": [total.tobytes()]})


def bucket_counts(docs: DataFrame, k: int) -> np.ndarray:
    rows = docs.select("text").mapInArrow(count_buckets(k), "chunk int, counts binary").groupBy("chunk").applyInPandas(
        add_counts, "chunk int, counts binary").collect()  # at most 2**COUNT_BITS numbers
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for r in rows:
        counts[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], "<i8")
    return counts


def needed(n: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The least overlap of a set of n with any set that reaches the share."""
    return -(-share[0] * n // share[1])


def describe(shared, k: int, share: tuple[int, int]):
    """Size, digest, centrality and rare-first prefix of each text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            size, digest, central, prefix = [], [], [], []
            for _, _, words in pieces(batch.column("text"), lower=True):
                for s in shingle_sets(words, k):
                    n = len(s)
                    often = counts[bucket(s)]
                    order = np.lexsort((s, often))[:n - int(needed(np.int64(n), share)) + 1]
                    size.append(n)
                    digest.append(hashlib.md5(s.tobytes()).digest() if n else None)
                    central.append(float(np.log2(1.0 + often).mean()) if n else 0.0)
                    prefix.append(s[order].tobytes() if n else None)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                pa.array(central, pa.float64()), pa.array(prefix, pa.binary())],
                ["doc_id", "text_key", "n", "digest", "central", "prefix"])
    return run


def post(shared):
    """A row per prefix shingle of each class; shingles of crowded buckets are salted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            prefixes = [np.frombuffer(x, np.uint64) for x in batch.column("prefix").to_pylist()]
            if not prefixes:
                continue
            sizes = np.array([len(p) for p in prefixes])
            token, row = np.concatenate(prefixes), np.repeat(np.arange(len(sizes)), sizes)
            cid = batch.column("cid").to_numpy()[row]
            salts = counts[bucket(token)] // GROUP_ROWS + 1
            yield pa.RecordBatch.from_arrays([
                pa.array(token.view(np.int64)), pa.array((cid % salts).astype(np.int32)), pa.array(salts > 1), pa.array(cid),
                pa.array(batch.column("n").to_numpy()[row].astype(np.int32)),
                pa.array((np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)),
                pa.array(batch.column("central").to_numpy()[row].astype(np.float32))],
                ["token", "salt", "salted", "cid", "n", "pos", "central"])
    return run


POSTED = "token long, salt int, salted boolean, cid long, n int, pos int, central float"
STARRED = "token long, cid long, n int, pos int, pivot long, pivot_n int, pivot_pos int"


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted postings come in; those of groups of two or more go out with their group's first row.

    Rows of salted groups always go out, for their shingle may have rows under another salt.
    Holds a batch and one row: the last one, whose group may go on.
    """
    names = ["token", "salt", "cid", "n", "pos", "salted"]
    last: np.ndarray | None = None  # the last row so far
    first: np.ndarray | None = None  # the first row of its group
    waits = False  # whether it is alone in its group and has not gone out
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], axis=1)
        joined = rows if last is None else np.concatenate([last[None], rows])
        new = np.ones(len(joined), bool)
        new[1:] = (joined[1:, :2] != joined[:-1, :2]).any(axis=1)
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        pivots = joined[head]
        if first is not None:
            pivots[0] = first
        size = np.diff(np.append(head, len(joined)))
        out = (size[group] > 1) | (joined[:, 5] == 1)
        if last is not None:
            out[0] = waits and size[0] > 1
        body, pivot = joined[out], pivots[group[out]]
        yield pa.RecordBatch.from_arrays([
            pa.array(body[:, 0]), pa.array(body[:, 2]), *(pa.array(body[:, i].astype(np.int32)) for i in (3, 4)),
            pa.array(pivot[:, 2]), *(pa.array(pivot[:, i].astype(np.int32)) for i in (3, 4))],
            ["token", "cid", "n", "pos", "pivot", "pivot_n", "pivot_pos"])
        waits = bool(size[-1] == 1 and joined[-1, 5] == 0 and (len(head) > 1 or last is None))
        last, first = joined[-1], pivots[-1]


def filters(a: str, b: str, share: tuple[int, int]) -> str:
    """Length and positional filters on two posting rows: the overlap that is still possible meets the one that is needed."""
    x, y = share
    return (
        f"{y} * least({a}n, {b}n) >= {x} * greatest({a}n, {b}n) AND "
        f"{x + y} * least({a}n - {a}pos, {b}n - {b}pos) >= {x} * ({a}n + {b}n)")


def reaches(overlap: int, n: int, m: int, share: tuple[int, int]) -> bool:
    return share[1] * overlap >= share[0] * (n + m - overlap)


def prefix_bound(batches: Iterator[pa.RecordBatch], share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs whose prefixes allow the threshold: shared prefix shingles plus what lies behind the prefixes."""
    for batch in batches:
        ok = []
        for p, q, n, m in zip(*(batch.column(c).to_pylist() for c in ("prefix_a", "prefix_b", "n_a", "n_b")), strict=True):
            x, y = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            # A shingle of one prefix that the other lacks may still lie behind the other's prefix, but not both ways:
            # the prefix that ends first in the global order is wholly compared.
            ok.append(reaches(min(n, m, common + max(n - len(x), m - len(y))), n, m, share))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def suffix_distance(x: np.ndarray, y: np.ndarray, depth: int) -> int:
    """A lower bound of the number of elements in one set only, by halving both at a middle element."""
    if not depth or not len(x) or not len(y):
        return abs(len(x) - len(y))
    middle = y[len(y) // 2]
    i, j = int(np.searchsorted(x, middle)), len(y) // 2
    return suffix_distance(x[:i], y[:j], depth - 1) + suffix_distance(x[i:], y[j:], depth - 1)


def linked(x: np.ndarray, y: np.ndarray, share: tuple[int, int]) -> bool:
    n, m = len(x), len(y)
    apart = suffix_distance(x, y, 3)
    if not reaches((n + m - apart) // 2, n, m, share):
        return False
    return reaches(len(np.intersect1d(x, y, assume_unique=True)), n, m, share)


def whole_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for _, _, words in pieces(batch.column("text"), lower=True) for s in shingle_sets(words, k)]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(sets, pa.binary())], ["cid", "shingles"])
    return run


def verify(candidates: DataFrame, classes: DataFrame, docs: DataFrame, k: int, share: tuple[int, int], label: str) -> DataFrame:
    """The links among distinct pairs ``(a, b)`` of classes."""
    side = classes.select("cid", "n", "prefix")
    a, b = (side.select(*(F.col(c).alias(f"{c}_{x}") for c in side.columns)) for x in "ab")
    held = saved(
        candidates.join(a, F.col("a") == F.col("cid_a")).join(b, F.col("b") == F.col("cid_b"))
        .select("a", "b", "n_a", "n_b", "prefix_a", "prefix_b")
        .mapInArrow(lambda batches: prefix_bound(batches, share), "a long, b long"), f"{label}-held")
    wanted = held.select(F.explode(F.array("a", "b")).alias("cid")).distinct().join(classes.select("cid", "doc_id", "text_key"), "cid")
    sets = saved(
        docs.join(wanted, same_row(docs, wanted)).dropDuplicates(["cid"]).select("cid", "text")
        .mapInArrow(whole_sets(k), "cid long, shingles binary"), f"{label}-sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = pa.array([
                linked(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), share)
                for p, q in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], ["a", "b"])

    x, y = (sets.select(F.col("cid").alias(c), F.col("shingles").alias(v)) for c, v in (("a", "x"), ("b", "y")))
    return saved(held.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long"), f"{label}-links")


def near_components(docs: DataFrame, k: int = SHINGLE, share: tuple[int, int] = SHARE) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and ``is_first`` (the row that stands for its component): a row per input row."""
    docs = keyed(docs)
    counts = bucket_counts(docs, k)
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # 2**COUNT_BITS numbers
    sets = saved(docs.mapInArrow(
        describe(shared, k, share), "doc_id long, text_key long, n long, digest binary, central double, prefix binary"), "jaccard-sets")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = saved(
        sets.where("n > 0").groupBy("digest").agg(
            F.min(rank).alias("least"), F.first("n").alias("n"), F.first("central").alias("central"), F.first("prefix").alias("prefix"))
        .select(F.monotonically_increasing_id().alias("cid"), "digest", "n", "central", "prefix", "least",
                F.col("least.doc_id").alias("doc_id"), F.col("least.text_key").alias("text_key")), "jaccard-classes")
    posted = classes.select("cid", "n", "central", "prefix").mapInArrow(post(shared), POSTED)
    starred = saved(
        posted.repartition("token", "salt").sortWithinPartitions("token", "salt", F.desc("central"), "cid").mapInArrow(stars, STARRED),
        "jaccard-stars")
    pairs = starred.where("cid != pivot").where(
        filters("", "pivot_", share)).select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")).distinct()
    links = verify(pairs, classes, docs, k, share, "jaccard-star")
    roots = components(links, "jaccard")
    rooted = starred.select("token", "cid", "n", "pos").join(
        roots, F.col("cid") == F.col("node"), "left").select("token", "cid", "n", "pos", F.coalesce("root", "cid").alias("root"))
    mixed = saved(
        rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token"),
        "jaccard-mixed")
    left = saved(rooted.join(mixed, "token", "left_semi"), "jaccard-left")
    u, v = left.alias("u"), left.alias("v")
    more = u.join(v, F.expr(f"u.token = v.token AND u.root < v.root AND {filters('u.', 'v.', share)}")).select(
        F.least("u.cid", "v.cid").alias("a"), F.greatest("u.cid", "v.cid").alias("b")).distinct()
    late = verify(saved(more, "jaccard-more"), classes, docs, k, share, "jaccard-late")
    if late.limit(1).count():
        roots = components(links.union(late), "jaccard")
    known = classes.select("cid", "digest", "least").join(roots, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    named = known.groupBy("root").agg(F.min("least").alias("name"))
    member = saved(known.join(named, "root").select("digest", "name"), "jaccard-members")
    rows = sets.select("doc_id", "text_key", "n", "digest").join(member, "digest", "left")
    return rows.select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("name.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("name.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("name.text_key") == F.col("text_key")))).alias("is_first"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP3_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS s
  FROM d, unnest(generate_series(1, greatest(CAST(len(w) AS BIGINT) - {SHINGLE - 1}, 1))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
edges AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE {SHARE[1]} * common >= {SHARE[0]} * (x.n + y.n - common)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""
