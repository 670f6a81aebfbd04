"""SimHash near-duplicates: fingerprints joined by a Gray-order hierarchical index, and their components.

A text's fingerprint has 64 bits; a bit is 1 if it is set in over half the XXH64 values (seed 42)
of the text's word shingles. Texts with equal fingerprints form a class and are joined once.

1. Distinct fingerprints are sorted by Gray rank, the place of a code in the reflected Gray
   order, in which neighbours differ in few bits, and cut into blocks of at most ``BLOCK``.
2. An index node holds what its fingerprints share: a mask of the bits that are alike in
   all of them, and these bits. Blocks are leaves of the upper index, whose nodes are the prefixes of
   the Gray rank, ``STEP`` bits a level, deep enough that a node has at most ``2**STEP`` blocks (or the rank ends). Inside a block
   the same index goes on with ``FAN`` neighbours a node, down to single fingerprints.
3. The index is joined with itself from the root. For a pair of nodes, the bits that both masks know
   are compared; a pair with more differences than allowed is dropped with all below it. Upper levels are equi-joins on the
   parent, a pair of blocks is walked in one task. A pair of leaves knows all 64 bits, so nothing is missed or wrong.

A fingerprint has at most 2,080 others within two bits, however many copies a text has, so no group is
expanded into all its pairs. A pair of blocks reports a spanning forest of its links, at most one row a
fingerprint. Results: NULL text and text without words have fingerprint zero and are linked like
any other; a text of fewer than ``k`` words has one shingle. Repeats are copies. A component is
named by its smallest id; it has no name if all its ids are NULL. No document, no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.shared import components, keyed, saved, table
from lakestar.llm.words import word_runs

SHINGLE = 3
SEED = 42
APART = 2
BLOCK = 4096
FAN = 4
STEP = 4
PAIRS = 1 << 16
ALL = np.uint64(2**64 - 1)


def fingerprint(text: bytes, k: int) -> int:
    """The text's 64 bits as a signed number; shingles are hashed a run of words at a time."""
    counts, n, held = np.zeros(64, np.int64), 0, []

    def add(digests: list[bytes]) -> None:
        nonlocal counts, n
        counts += np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(digests)

    digest = xxhash.xxh64_digest
    for run in word_runs(text.lower()):
        words = held + run
        if len(words) >= k:
            stops = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.concatenate([[0], stops[:-1] + 1])
            joined = b" ".join(words)
            add([digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - k + 1].tolist(), stops[k - 1:].tolist(), strict=True)])
        held = words[max(0, len(words) - k + 1):]
    if not n and held:
        add([digest(b" ".join(held), SEED)])
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", k) for t in batch.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(codes, pa.int64())], ["doc_id", "text_key", "code"])
    return run


def gray_rank(code: Column) -> Column:
    """The place of a code in the Gray order, as 64 unsigned bits."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def shared_bits(known: np.ndarray, bits: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the bits alike in all members of each run, and these bits."""
    low, high = np.bitwise_and.reduceat(bits, starts), np.bitwise_or.reduceat(bits, starts)
    known = np.bitwise_and.reduceat(known, starts) & ~(low ^ high)
    return known, low & known


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes in Gray order come in; blocks of them go out. Holds less than a block and a batch."""
    held_codes, held_ranks = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def packed(codes: np.ndarray, ranks: np.ndarray) -> pa.RecordBatch:
        starts = np.arange(0, len(codes), BLOCK)
        known, bits = shared_bits(np.full(len(codes), ALL), codes, starts)
        return pa.RecordBatch.from_arrays([
            pa.array(ranks[starts]), pa.array(known.view(np.int64)), pa.array(bits.view(np.int64)),
            pa.array([codes[s:s + BLOCK].tobytes() for s in starts], pa.binary())], ["rank", "known", "bits", "codes"])

    for batch in batches:
        held_codes = np.concatenate([held_codes, batch.column("code").to_numpy().view(np.uint64)])
        held_ranks = np.concatenate([held_ranks, batch.column("rank").to_numpy()])
        whole = len(held_codes) // BLOCK * BLOCK
        if whole:
            yield packed(held_codes[:whole], held_ranks[:whole])
            held_codes, held_ranks = held_codes[whole:], held_ranks[whole:]
    if len(held_codes):
        yield packed(held_codes, held_ranks)


def levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The index of a block, single codes first."""
    out = [(np.full(len(codes), ALL), codes)]
    for _ in range(6):  # FAN ** 6 codes a block
        known, bits = out[-1]
        out.append(shared_bits(known, bits, np.arange(0, len(bits), FAN)))
    return out


def near_pairs(x: list, y: list, same: bool, apart: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``(i, j)`` of codes at most ``apart`` bits apart, some pairs at a time; of a block with itself each pair once."""
    def kept(level: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        (known_x, bits_x), (known_y, bits_y) = x[level], y[level]
        near = np.bitwise_count((bits_x[i] ^ bits_y[j]) & known_x[i] & known_y[j]) <= apart
        return i[near], j[near]

    top = len(x) - 1
    i, j = (side.ravel() for side in np.indices((len(x[top][0]), len(y[top][0]))))
    open_ = [(top, *kept(top, i, j))]
    while open_:
        level, i, j = open_.pop()
        if level == 0:
            apart_ = i < j if same else slice(None)
            yield i[apart_], j[apart_]
            continue
        i = (i[:, None, None] * FAN + np.arange(FAN)[None, :, None] + np.zeros((1, 1, FAN), np.int64)).ravel()
        j = (j[:, None, None] * FAN + np.arange(FAN)[None, None, :] + np.zeros((1, FAN, 1), np.int64)).ravel()
        there = (i < len(x[level - 1][0])) & (j < len(y[level - 1][0]))
        if same:
            there &= i <= j
        i, j = kept(level - 1, i[there], j[there])
        open_ += [(level - 1, i[at:at + PAIRS], j[at:at + PAIRS]) for at in range(0, len(i), PAIRS)]


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining ``i`` with ``j``; a label is the smallest place of its group."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label = label[label]


def forests(apart: int):
    """Pairs of blocks come in; edges that join what is linked within a pair go out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((2, 0), np.int64)]
            for same, p, q in zip(*(batch.column(c).to_pylist() for c in ("same", "x", "y")), strict=True):
                x = np.frombuffer(p, np.uint64)
                y = x if same else np.frombuffer(q, np.uint64)
                codes = x if same else np.concatenate([x, y])
                label = np.arange(len(codes))
                for i, j in near_pairs(levels(x), levels(y), same, apart):
                    label = unite(label, i, j if same else j + len(x))
                moved = np.flatnonzero(label != np.arange(len(label)))
                found.append(np.stack([codes[moved], codes[label[moved]]]).view(np.int64))
            a, b = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
    return run


def prefix(rank: Column, depth: int) -> Column:
    return F.shiftrightunsigned(rank, 64 - depth) if depth else F.lit(0).cast("long")


def upper_nodes(leaves: DataFrame, depth: int) -> DataFrame:
    """The index nodes at a depth of the Gray rank."""
    alike = F.col("both").bitwiseAND(F.bitwise_not(F.col("low").bitwiseXOR(F.col("high"))))
    return leaves.groupBy(prefix(F.col("rank"), depth).alias("node")).agg(
        F.bit_and("known").alias("both"), F.bit_and("bits").alias("low"), F.bit_or("bits").alias("high"), F.count("*").alias("size")).select(
        "node", "size", alike.alias("known"), F.col("low").bitwiseAND(alike).alias("bits"))


def narrowed(pairs: DataFrame, nodes: DataFrame, apart: int) -> DataFrame:
    """Pairs ``(a, b)`` of parents become pairs of their children ``(node, parent, known, bits)`` that may hold links."""
    x, y = (nodes.select(*(F.col(c).alias(f"{c}_{s}") for c in ("node", "parent", "known", "bits"))) for s in "xy")
    differ = F.col("bits_x").bitwiseXOR(F.col("bits_y")).bitwiseAND(F.col("known_x")).bitwiseAND(F.col("known_y"))
    return pairs.join(x, F.col("a") == F.col("parent_x")).join(y, F.col("b") == F.col("parent_y")).where(
        (F.col("node_x") <= F.col("node_y")) & (F.bit_count(differ) <= apart)).select(F.col("node_x").alias("a"), F.col("node_y").alias("b"))


def near_blocks(leaves: DataFrame, apart: int) -> DataFrame:
    """Pairs ``(a, b)`` of blocks that the upper index cannot part; ``a = b`` is a block with itself.

    ``place`` puts unsigned ranks into signed order, so that a child of the smaller parent is the smaller one.
    """
    pairs = leaves.sparkSession.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    depth = 0
    while depth < 60 and (upper_nodes(leaves, depth).agg(F.max("size")).first()[0] or 0) > 2**STEP:
        below = upper_nodes(leaves, depth + STEP).withColumn("parent", F.shiftrightunsigned("node", STEP))
        pairs = saved(narrowed(pairs, below, apart), "simhash-nodes")
        depth += STEP
    return narrowed(pairs, leaves.select(
        F.col("place").alias("node"), prefix(F.col("rank"), depth).alias("parent"), "known", "bits"), apart)


def near_fingerprints(docs: DataFrame, k: int = SHINGLE, apart: int = APART) -> DataFrame:
    """doc_id, text_key, code (the fingerprint as a signed number) and component_id: a row per input row.

    Fingerprints at most ``apart`` bits apart are linked.
    """
    rows = saved(keyed(docs).mapInArrow(fingerprints(k), "doc_id long, text_key long, code long"), "simhash-rows")
    classes = rows.groupBy("code").agg(F.min("doc_id").alias("least"))
    flipped = F.col("rank").bitwiseXOR(F.lit(-2**63).cast("long"))
    ordered = classes.select("code", gray_rank(F.col("code")).alias("rank")).withColumn("place", flipped).repartitionByRange("place").sortWithinPartitions("place")
    leaves = saved(
        ordered.select("code", "rank").mapInArrow(blocks, "rank long, known long, bits long, codes binary").withColumn("place", flipped), "simhash-blocks")
    pairs = saved(near_blocks(leaves.drop("codes"), apart), "simhash-pairs")
    x, y = (leaves.select(F.col("place").alias(p), F.col("codes").alias(c)) for p, c in (("a", "x"), ("b", "y")))
    edges = pairs.join(x, "a").join(y, "b").select((F.col("a") == F.col("b")).alias("same"), "x", "y").mapInArrow(forests(apart), "a long, b long")
    roots = components(edges, "simhash")
    known = classes.join(roots, F.col("code") == F.col("node"), "left").withColumn("root", F.coalesce("root", "code"))
    names = known.groupBy("root").agg(F.min("least").alias("component_id"))
    members = saved(known.select("code", "root").join(names, "root").select("code", "component_id"), "simhash-members")
    return rows.join(members, "code").select("doc_id", "text_key", "code", "component_id")


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
