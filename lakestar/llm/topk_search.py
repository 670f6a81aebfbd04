"""Exact top-k inner products by a dual-tree search over a cover tree.

Queries and data share one tree. Its shape is fitted on a bounded sample: a node's children are a
net of its points, chosen farthest first, so that each child covers what is near it. Every row
goes down to the leaf of the nearest child and is indexed there; covering radii are the largest
distances of the rows that came, so they hold for all rows.

1. Each query is scored against its own leaf, which gives the query, and by the minimum its
   group, a worst kth score.
2. Node pairs are walked from the top: a group with centre p and radius r and a node with centre
   c and radius s have no score above ``p.c + r|c| + s|p| + rs``. A pair below the group's worst
   kth score is pruned with all that is under it.
3. What is left is scored in blocks: rows of a leaf are packed into matrices of at most ``BLOCK``
   rows, and only scores that reach the query's own kth score go on to the final ranking.

Components are whole numbers, so scores are exact; ties go to the smaller id. Results: vectors
that are NULL or hold NULL or non-finite components take no part, nor do rows without id. A
vector that is shorter than another counts as filled up with zeros. Rows of one id with equal
vectors are one row; a row is no candidate for queries of its id. Fewer than k candidates: all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.llm.shared import hash_sample, saved, table

K = 5
EVERY = 50
SAMPLE = 4096
FAN = 16
LEAF_SAMPLE = 64
BLOCK = 4096
SLACK = 1e-6  # for rounding in the bounds


@dataclass
class Node:
    """A centre, its children, and for leaves a number."""

    centre: np.ndarray
    children: list[Node] = field(default_factory=list)
    leaf: int = -1


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of whole-number matrices; beyond what doubles hold, by Python integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = lambda x: np.array([[int(v) for v in row] for row in x], object)
    return np.clip(exact(a) @ exact(b).T, -(2**63), 2**63 - 1).astype(np.int64)


def widen(rows: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def build(points: np.ndarray, leaves: list[np.ndarray]) -> Node:
    """A cover tree of the sample: children are a farthest-first net that halves the radius, at most ``FAN`` of them."""
    node = Node(points[0])
    away = np.linalg.norm(points - node.centre, axis=1)
    if len(points) <= LEAF_SAMPLE or not away.max():
        node.leaf = len(leaves)
        leaves.append(node.centre)
        return node
    net, owner, near = [0], np.zeros(len(points), np.int64), away.copy()
    while len(net) < FAN and near.max() > away.max() / 2:
        net.append(int(near.argmax()))
        far = np.linalg.norm(points - points[net[-1]], axis=1)
        owner[far < near] = len(net) - 1
        near = np.minimum(near, far)
    for j, i in enumerate(net):
        mine = np.flatnonzero(owner == j)
        if len(mine):
            node.children.append(build(points[np.concatenate([[i], mine[mine != i]])], leaves))
    return node


def descend(node: Node, points: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """The leaf of every row: by the nearest child at each node."""
    if node.leaf >= 0:
        out[rows] = node.leaf
        return
    away = np.stack([np.linalg.norm(points[rows] - c.centre, axis=1) for c in node.children], axis=1)
    nearest = away.argmin(axis=1)
    for j, child in enumerate(node.children):
        if (nearest == j).any():
            descend(child, points, rows[nearest == j], out)


def clean(vectors: DataFrame) -> DataFrame:
    """vec_id and whole-number components, one row per id and vector."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256.0).cast("double"))
    fine = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))
    return vectors.where(F.col("vec_id").isNotNull() & fine).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x")).distinct()


def place(tree, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, centres = tree.value
        for batch in batches:
            points = widen([x.values.to_numpy() for x in batch.column("x")], width)
            leaf = np.zeros(len(points), np.int64)
            descend(root, points, np.arange(len(points)), leaf)
            away = np.linalg.norm(points - centres[leaf], axis=1) if len(points) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(leaf.astype(np.int32)), pa.array(away), pa.array([p.astype("<f8").tobytes() for p in points], pa.binary())],
                ["vec_id", "leaf", "away", "x"])
    return run


def block_rows(group: pd.DataFrame) -> pd.DataFrame:
    order = group.sort_values("vec_id")
    return pd.DataFrame({
        "leaf": [int(order["leaf"].iloc[0])], "ids": [order["vec_id"].to_numpy().astype("<i8").tobytes()], "xs": [b"".join(order["x"])],
        "floors": [order["floor"].to_numpy().astype("<f8").tobytes()]})


def blocks(rows: DataFrame, n: Column, name: str) -> DataFrame:
    """Rows of a leaf packed into matrices; a leaf of ``n`` rows is dealt over as many blocks as it needs."""
    number = F.pmod(F.xxhash64("vec_id", "x"), F.ceil(n * 2 / BLOCK))
    packed = rows.withColumn("block", number).groupBy("leaf", "block").applyInPandas(
        block_rows, "leaf int, ids binary, xs binary, floors binary")
    return packed.select("leaf", *(F.col(c).alias(f"{name}_{c}") for c in ("ids", "xs", "floors")))


def score(width: int, k: int):
    """The best candidates of each query in a block, as far as they reach the query's floor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q_xs, floors, d_ids, d_xs in zip(*(batch.column(c).to_pylist() for c in ("q_ids", "q_xs", "q_floors", "d_ids", "d_xs")), strict=True):
                queries, data = np.frombuffer(q_ids, "<i8"), np.frombuffer(d_ids, "<i8")
                points = np.frombuffer(d_xs, "<f8").reshape(len(data), width)
                found = dot(np.frombuffer(q_xs, "<f8").reshape(len(queries), width), points)
                rows = []
                for q, floor, s in zip(queries, np.frombuffer(floors, "<f8"), found, strict=True):
                    at = np.flatnonzero((s >= floor) & (data != q))
                    at = at[np.lexsort((data[at], -s[at]))[:k]]
                    rows.append((np.full(len(at), q), data[at], s[at]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows, strict=True)], ["query_id", "vec_id", "score"])
    return run


SCORED = "query_id long, vec_id long, score long"


def best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def walk(root: Node, stats: dict[int, tuple], groups: dict[int, tuple]) -> list[tuple[int, int]]:
    """Pairs of a query group and a leaf that the bound doesn't prune, from the top of the tree."""
    reach: dict[int, tuple] = {}

    def cover(node: Node) -> tuple[list[int], float]:
        """Leaves with rows below a node, and its covering radius."""
        if node.leaf >= 0:
            own = ([node.leaf], stats[node.leaf][0]) if node.leaf in stats else ([], 0.0)
        else:
            parts = [(c, *cover(c)) for c in node.children]
            own = ([x for _, below, _ in parts for x in below], max((np.linalg.norm(node.centre - c.centre) + r for c, below, r in parts if below), default=0.0))
        reach[id(node)] = own
        return own

    cover(root)
    pairs = []
    for group, (centre, radius, worst) in groups.items():
        stack, size = [root], float(np.linalg.norm(centre))
        while stack:
            node = stack.pop()
            below, r = reach[id(node)]
            if not below:
                continue
            far = float(np.linalg.norm(node.centre))
            bound = float(centre @ node.centre) + radius * far + r * size + radius * r
            if bound + SLACK * (1 + abs(bound)) < worst:
                continue
            pairs += [(group, node.leaf)] if node.leaf >= 0 else []
            stack += node.children
    return pairs


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = clean(vectors)
    drawn = [np.array(r["x"]) for r in hash_sample(rows, ["vec_id", "x"], sample, vectors.count()).select("x").collect()]  # a bounded sample
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not drawn:
        return empty
    width = int(rows.agg(F.max(F.size("x"))).first()[0])
    leaves: list[np.ndarray] = []
    root = build(widen(drawn, width), leaves)
    tree = spark.sparkContext.broadcast((root, np.stack(leaves)))  # at most ``sample`` centres
    placed = saved(rows.mapInArrow(place(tree, width), "vec_id long, leaf int, away double, x binary"), "topk-placed")
    asked = F.col("vec_id") % every == 0
    stats = {r["leaf"]: (r["radius"], r["n"], r["asked"], r["asked_radius"]) for r in placed.groupBy("leaf").agg(
        F.max("away").alias("radius"), F.count("*").alias("n"), F.count(F.when(asked, 1)).alias("asked"),
        F.max(F.when(asked, F.col("away"))).alias("asked_radius")).collect()}  # a row per leaf
    counts = spark.createDataFrame([(leaf, s[1]) for leaf, s in stats.items()], "leaf int, n long")
    data = saved(blocks(placed.withColumn("floor", F.lit(0.0)).join(F.broadcast(counts), "leaf"), F.col("n"), "d"), "topk-data")
    n_asked = sum(s[2] for s in stats.values())

    def scored(queries: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
        """Queries go to the leaves that their group has left, and there in matrices against the leaf's."""
        listed = spark.createDataFrame(pairs, "leaf int, d_leaf int")  # at most leaves squared
        sent = queries.join(F.broadcast(listed), "leaf").select(F.col("d_leaf").alias("leaf"), "vec_id", "x", "floor")
        return blocks(sent, F.lit(n_asked), "q").join(data, "leaf").select("q_ids", "q_xs", "q_floors", "d_ids", "d_xs").mapInArrow(
            score(width, k), SCORED)

    own = [(leaf, leaf) for leaf, s in stats.items() if s[2]]
    if not own:
        return empty
    queries = placed.where(asked)
    first = scored(queries.withColumn("floor", F.lit(float("-inf"))), own)
    floors = saved(best(first, k).groupBy("query_id").agg(
        F.min("score").alias("least"), F.count("*").alias("n")).select("query_id", F.when(F.col("n") >= k, F.col("least").cast("double")).alias("floor")), "topk-floors")
    floored = saved(queries.join(floors, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", "leaf", "x", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")), "topk-queries")
    worst = {r["leaf"]: r["worst"] for r in floored.groupBy("leaf").agg(F.min("floor").alias("worst")).collect()}  # a row per leaf
    groups = {leaf: (leaves[leaf], stats[leaf][3], worst[leaf]) for leaf, _ in own}
    return best(scored(floored, walk(root, stats, groups)), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP2_SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}
"""
