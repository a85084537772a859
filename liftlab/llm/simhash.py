"""SimHash near-duplicates: vantage-point shards, exact pairs within a Hamming radius, components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlab.llm.common import slices
from liftlab.session import written

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Expected distinct fingerprints of one shard.
SHARD_SIZE = 32_768
#: Distinct fingerprints from which the upper tree is built; every fingerprint is then routed exactly.
TREE_SAMPLE = 4_096
LEAF = 128
BLOCK = 1 << 22

_ONE = np.uint64(1)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes; no words: 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    cuts = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    hashed = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in cuts),
                         np.uint64, len(words) - shingle + 1)
    # counts of set bits in blocks of rows, so that a very long text needs little memory
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashed), 65_536):
        bits = np.unpackbits(hashed[at:at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int((_ONE << np.flatnonzero(2 * counts > len(hashed)).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with the 64 bits of each whole text's fingerprint as a signed long; map only."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 512):
                bits = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(bits.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, fp long")


# ---------------------------------------------------------------- vantage-point trees
def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


@dataclass
class Node:
    """Inside: distance to the vantage point of at most ``border``; else outside. A leaf is a shard."""

    point: np.uint64 = np.uint64(0)
    border: int = 0
    inside: Node | None = None
    outside: Node | None = None
    shard: int = -1


def split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point and border that part ``points`` with few of them near the border."""
    best, least = None, None
    for point in points[:: max(1, len(points) // 8)][:8]:
        count = np.bincount(distance(points, point), minlength=65)
        below = np.cumsum(count)
        for border in range(64):
            small = min(below[border], len(points) - below[border])
            if small * 4 < len(points):
                continue
            near = count[max(0, border - RADIUS + 1):border + RADIUS + 1].sum()
            if least is None or near < least:
                best, least = (point, border), near
    return best


def build(points: np.ndarray, depth: int, shards: list[int]) -> Node:
    """The upper tree; ``shards`` gets the numbers of its leaves."""
    cut = split(points) if depth and len(points) > 8 else None
    if cut is None:
        shards.append(len(shards))
        return Node(shard=shards[-1])
    near = distance(points, cut[0]) <= cut[1]
    return Node(*cut, build(points[near], depth - 1, shards), build(points[~near], depth - 1, shards))


def route(node: Node, points: np.ndarray, home: np.ndarray, radius: int, out: list) -> None:
    """Give each point to every shard that its ball reaches; ``home`` marks where it lives."""
    if not len(points):
        return
    if node.shard >= 0:
        out.append((node.shard, points, home))
        return
    far = distance(points, node.point).astype(np.int64)
    at = far <= node.border + radius
    route(node.inside, points[at], home[at] & (far[at] <= node.border), radius, out)
    at = far + radius > node.border
    route(node.outside, points[at], home[at] & (far[at] > node.border), radius, out)


class Roots:
    """Union-find over positions, with whole arrays of links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            differ = ra != rb
            if not differ.any():
                return
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (flat := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = flat


def link_near(points: np.ndarray, home: np.ndarray, radius: int) -> np.ndarray:
    """Root positions after linking each point to all home points within ``radius``."""
    roots = Roots(len(points))

    def visit(members: np.ndarray, queries: np.ndarray) -> None:
        if not len(members) or not len(queries):
            return
        cut = split(points[members]) if len(members) > LEAF else None
        if cut is None:  # a leaf, or points too much alike to be parted
            step = max(1, BLOCK // len(members))
            for at in range(0, len(queries), step):
                block = queries[at:at + step]
                q, m = np.nonzero(distance(points[block][:, None], points[members][None, :]) <= radius)
                roots.link(block[q], members[m])
            return
        point, border = cut
        of_members = distance(points[members], point)
        of_queries = distance(points[queries], point).astype(np.int64)
        visit(members[of_members <= border], queries[of_queries <= border + radius])
        visit(members[of_members > border], queries[of_queries + radius > border])

    visit(np.flatnonzero(home), np.arange(len(points)))
    return roots.root


def near_links(distinct: DataFrame, radius: int = RADIUS, shard_size: int = SHARD_SIZE,
               tree_sample: int = TREE_SAMPLE) -> DataFrame:
    """(u, v) links that join all distinct fingerprints ``fp`` within ``radius`` of each other.

    The upper tree is built from a bounded sample and only routes: a fingerprint lives in one
    shard and visits every shard that the triangle bound cannot rule out, so no pair is missed.
    A shard links by union-find and returns one link per fingerprint, never all pairs of a group.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    sample = [r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(tree_sample).collect()]
    depth = max(0, (max(n, 1) - 1).bit_length() - (shard_size - 1).bit_length())
    shards: list[int] = []
    tree = build(np.array(sample, np.int64).view(np.uint64), depth, shards)
    shared = spark.sparkContext.broadcast(tree)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.asarray(batch.column(0)).view(np.uint64)
            out: list = []
            route(shared.value, points, np.ones(len(points), bool), radius, out)
            for shard, part, home in out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), shard, np.int32)), pa.array(part.view(np.int64)),
                     pa.array(home)], ["shard", "fp", "home"])

    def join(group: pa.Table) -> pa.Table:
        points = group.column("fp").to_numpy().view(np.uint64)
        root = link_near(points, group.column("home").to_numpy(), radius)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"u": points[moved].view(np.int64), "v": points[root[moved]].view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "shard int, fp long, home boolean")
    return dealt.groupBy("shard").applyInArrow(join, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every vertex of the links (u, v); root is its component's least vertex.

    Alternates large-star and small-star steps on the links, each written to the shared folder.
    """
    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
            if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(least, "u")
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                least.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    edges = written(links.filter("u <> v").distinct(), "links")
    state = None
    while True:
        edges = written(star(star(edges, True), False), "star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select("u", F.col("v").alias("root"))
        state = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    shard_size: int = SHARD_SIZE) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over links of ``radius`` bits.

    Whole texts count; copies meet as one distinct fingerprint. A null, empty or blank text has
    fingerprint zero and links like any other. Repeated rows give repeated rows. Null ids are
    left out of the minimum, so a component of null ids alone has a null id. An empty table gives
    no rows; other columns are not read.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(near_links(distinct, radius, shard_size))
    ids = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left") \
        .select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    ids = written(ids, "roots")
    of_root = ids.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return prints.join(ids.join(of_root, "root").select("fp", "component_id"), "fp") \
        .select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, **options) -> DataFrame:
    """The rows whose id is their own component's smallest; rows with a null id are kept.

    Rows are judged by id and fingerprint: of rows that repeat an id with other texts, each stays if
    its own component keeps that id, so every component keeps a row. All columns of ``docs`` stay.
    """
    gone = near_duplicates(docs, shingle, **options).filter("doc_id <> component_id") \
        .select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp")).distinct()
    row = docs.schema.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 512):
                bits = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(bits.view(np.int64))], ["row", "fp"])

    rows = docs.select(F.struct(*docs.columns).alias("row"), "text").mapInArrow(run, f"row {row}, fp long")
    return rows.join(gone, (F.col("row.doc_id") == F.col("_id")) & (F.col("fp") == F.col("_fp")), "left_anti") \
        .select("row.*")
