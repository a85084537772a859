"""Exact top-k search: tiled integer matrix products, partial selection, tree merging."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
K = 5
QUERY_EVERY = 50
#: Vectors of a tile's two sides; a tile's scores are its only large array.
TILE_QUERIES = 2_048
TILE_VECTORS = 8_192
PRODUCT_ROWS = 256
#: Scores beyond a long are this, or less it.
LARGEST = 2**63 - 1
#: Lists that one step of the tree merges.
FAN_IN = 16

_FOUND = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v, n): vectors as integers floor(scale * x), x as double; a component beyond a long is its limit.

    Vectors that are null or hold null or non-finite components are left out.
    """
    x = F.col(vector).cast("array<double>")
    good = F.col(vector).isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias(vector)).filter(
        F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))) \
        .select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v")) \
        .withColumn("n", F.size("v"))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), np.int64).reshape(rows, -1)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products: by doubles while every partial sum is exact, else by integers."""
    top = lambda m: int(max(-int(m.min()), int(m.max()))) if m.size else 0
    bound = top(a) * top(b) * a.shape[1]
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -LARGEST, LARGEST).astype(np.int64)


def tile_best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> pa.Table:
    """The best ``k`` of one tile for each of its queries, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    out = []
    for at in range(0, len(q_ids), PRODUCT_ROWS):
        own = q_ids[at:at + PRODUCT_ROWS]
        score = _scores(q[at:at + PRODUCT_ROWS], v)
        for row, me in zip(score, own):
            other = np.flatnonzero(ids != me)
            if not len(other):
                continue
            value = row[other]
            if len(value) > k:
                # all that reach the k-th value, so that ties are decided by the id
                kth = np.partition(value, len(value) - k)[len(value) - k]
                near = np.flatnonzero(value >= kth)
            else:
                near = np.arange(len(value))
            near = near[np.lexsort((ids[other[near]], -value[near]))][:k]
            out.append((np.full(len(near), me), ids[other[near]], value[near]))
    cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
    return pa.table(dict(zip(("query_id", "vec_id", "score"), cols)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer products of each query.

    Both sides are dealt to tiles by a hash of the id: a tile holds about ``TILE_QUERIES`` queries
    and ``TILE_VECTORS`` vectors of one length, selects its own best, and the lists are merged in a
    tree of ``FAN_IN``, so memory is bounded at any size and nothing is broadcast. Vectors of
    another length than the query's take no part in its search. Every row is a candidate of its own,
    also one that repeats; rows of the query's id are its own and left out. Of several vectors under
    one query id, the least is asked. Fewer candidates than ``k``: all of them; none: no rows. Null
    ids take no part. Other columns are not read.
    """
    base = vectors
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("n", F.size("v"))
    n, m = base.count(), asked.count()
    shards, blocks = max(1, -(-n // TILE_VECTORS)), max(1, -(-m // TILE_QUERIES))
    every = lambda number: F.explode(F.sequence(F.lit(0), F.lit(number - 1)))
    home = lambda number: F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("int")
    left = asked.select("vec_id", "v", "n", home(blocks).alias("block"), every(shards).alias("shard"))
    # names of its own, as both sides may come from one table
    right = base.select(F.col("vec_id").alias("id"), F.col("v").alias("w"), F.col("n").alias("n"),
                        home(shards).alias("shard"), every(blocks).alias("block"))

    def search(key, left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
        if not left_rows.num_rows or not right_rows.num_rows:
            return tile_best(np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0, np.int64), np.zeros((0, 0)), k)
        return tile_best(
            left_rows.column("vec_id").to_numpy(), _matrix(left_rows.column("v"), left_rows.num_rows),
            right_rows.column("id").to_numpy(), _matrix(right_rows.column("w"), right_rows.num_rows), k)

    keys = ["n", "block", "shard"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, _FOUND)
    found = found.withColumn("part", F.pmod(F.xxhash64("query_id", "vec_id"), F.lit(shards)).cast("int"))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    while shards > FAN_IN:
        shards = -(-shards // FAN_IN)
        found = found.withColumn("part", F.col("part") % shards) \
            .groupBy("query_id", "part").agg(best.alias("b")) \
            .select("query_id", "part", F.explode("b").alias("b")) \
            .select("query_id", "part", "b.vec_id", (-F.col("b.s")).alias("score"))
    merged = found.groupBy("query_id").agg(best.alias("b"))
    return merged.select("query_id", F.posexplode("b").alias("p", "b")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.s")).alias("score"))
