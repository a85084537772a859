"""Exact ranked search over bit-sliced Bloom signatures.

The index is made once, without knowing the queries, and written to the shared folder. Its rows are slabs:
documents of like size, whose Bloom signatures stand side by side as columns of a bit matrix, stored by rows.
Row ``b`` of a slab is a bitmap of the documents whose signature has bit ``b``, so that the rows a word hashes to,
taken together by AND, are the documents that may hold it. A word goes in once for each of ``LEVELS`` that its
occurrences reach, so a level's bitmap bounds them from above.

A search adds the weights of the query words over these bitmaps, level by level. Signatures only ever err
upwards, and a score grows with each word's occurrences, so the sum bounds the score of every document. The
documents of the highest bounds are scored exactly; the k-th of these scores excludes all documents whose bound
cannot reach it, and every document that remains is scored exactly from its text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlab.llm.terms import count_pairs, text_parts, words_of
from liftlab.session import fresh_path, written

#: Fixed value of the contract: what lies between terms.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 20
#: Occurrences from which a level holds a word; the last level has no upper end.
LEVELS = (1, 2, 3, 4, 5, 6, 8, 10, 13, 17, 23, 32, 48, 80, 160, 400)
#: Bits of a signature per word and level that goes in, hashes per word, and the shortest and longest
#: signature. A longer document's signature is fuller, so its bounds are higher; it is never cut.
BITS_PER_WORD = 12
HASHES = 4
SHORTEST, LONGEST = 1 << 8, 1 << 20
#: Bits of a slab, from which follows how many documents it takes (8 at least).
SLAB_BITS = 1 << 22
#: Queries that are searched together.
BLOCK = 256
#: Place of a null id: it comes after all others.
NO_ID = 2**63 - 1

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SLABS = "bits int, ids array<long>, lengths array<long>, rows binary, terms long, term string, documents long"


def _keys(words: list[str]) -> np.ndarray:
    """Hashes of words, one row per word and a column per level."""
    base = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    mixed = base[:, None] + np.arange(1, len(LEVELS) + 1, dtype=np.uint64) * _GOLDEN
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key in a signature of ``bits`` (a power of two), along a new last axis."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    found = keys[..., None] + np.arange(HASHES, dtype=np.uint64) * step[..., None]
    return (found & np.uint64(bits - 1)).astype(np.int64)


def _slab(bits: int, docs: list[tuple[int | None, int, np.ndarray]]) -> dict:
    width = -(-len(docs) // 8) * 8
    matrix = np.zeros((bits, width), bool)
    for column, (_, _, keys) in enumerate(docs):
        matrix[_places(keys, bits).ravel(), column] = True
    return {"bits": bits, "ids": [d[0] for d in docs], "lengths": [d[1] for d in docs],
            "rows": np.packbits(matrix, axis=1).tobytes(), "terms": sum(d[1] for d in docs),
            "term": None, "documents": len(docs)}


def build_index(docs: DataFrame) -> DataFrame:
    """Slabs of all documents with a term, and per part of a task (term, documents) counts; one scan.

    Rows with ``term`` null are slabs; the others belong to the lexicon and add up to document frequencies.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bits", pa.int32()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                            ("rows", pa.binary()), ("terms", pa.int64()), ("term", pa.string()),
                            ("documents", pa.int64())])
        waiting: dict[int, list] = {}
        for batch in batches:
            for part in text_parts(batch, 1):
                row, word, distinct = words_of(part.column(1), SEPARATORS)
                if not len(row):
                    continue
                lengths = np.bincount(row, minlength=part.num_rows)
                row, word, times = count_pairs(row, word, distinct)
                held = np.bincount(word, minlength=len(distinct))
                used = np.flatnonzero(held)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(used), f.type) for f in list(schema)[:5]]
                    + [pa.array(distinct).take(pa.array(used)), pa.array(held[used])], schema=schema)
                keys = _keys(distinct)
                reached = [(row[times >= low], keys[word[times >= low], level]) for level, low in enumerate(LEVELS)]
                of = np.concatenate([r for r, _ in reached])
                order = np.argsort(of, kind="stable")
                flat = np.concatenate([k for _, k in reached])[order]
                borders = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=part.num_rows))])
                for doc, doc_id in enumerate(part.column(0).to_pylist()):
                    own = flat[borders[doc]:borders[doc + 1]]
                    if not len(own):
                        continue
                    bits = 1 << (BITS_PER_WORD * len(own) - 1).bit_length()
                    bits = min(max(bits, SHORTEST), LONGEST)
                    slab = waiting.setdefault(bits, [])
                    slab.append((doc_id, int(lengths[doc]), own))
                    if len(slab) >= max(8, SLAB_BITS // bits):
                        yield pa.RecordBatch.from_pylist([_slab(bits, waiting.pop(bits))], schema)
        for bits, slab in waiting.items():
            yield pa.RecordBatch.from_pylist([_slab(bits, slab)], schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SLABS)


def query_terms(items: DataFrame) -> DataFrame:
    """(q, item_id, term, times) of the distinct (item_id, text) rows, numbered by ``q``."""
    id_type = items.schema["item_id"].dataType.simpleString()
    numbered = written(items.select("item_id", "text").distinct().withColumn(
        "q", F.monotonically_increasing_id()), "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, 2):
                row, word, distinct = words_of(part.column(2), SEPARATORS)
                row, word, times = count_pairs(row, word, distinct)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                     pa.array(distinct, pa.string()).take(pa.array(word)), pa.array(times, pa.int64())],
                    ["q", "item_id", "term", "times"])

    return written(numbered.select("q", "item_id", "text").mapInArrow(
        run, f"q long, item_id {id_type}, term string, times long"), "query-terms")


@dataclass(frozen=True)
class Block:
    """A bounded number of queries with all a task needs to search for them.

    ``starts`` and ``queries`` list the queries of each word, ``weights`` what the word adds to each per unit.
    """

    words: list[str]
    starts: np.ndarray
    queries: np.ndarray
    weights: np.ndarray
    size: int
    documents: int
    terms: int
    exact: bool

    @classmethod
    def of(cls, rows: list[tuple[int, str, int, int]], size: int, documents: int, terms: int) -> Block:
        """From (query, term, times, document frequency)."""
        rows = sorted(rows, key=lambda r: (r[1], r[0]))
        words = sorted({r[1] for r in rows})
        place = {w: i for i, w in enumerate(words)}
        word = np.array([place[r[1]] for r in rows], np.int64)
        weight = [r[2] * math.floor(1000 * math.log((2 * documents + 2) / (2 * r[3] + 1))) for r in rows]
        return cls(words, np.searchsorted(word, np.arange(len(words) + 1)), np.array([r[0] for r in rows], np.int64),
                   np.array(weight, np.int64), size, documents, terms, sum(weight) * 10**6 < 2**53)

    def spread(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``word``, query, weight) for every query that has the word at that place."""
        counts = self.starts[word + 1] - self.starts[word]
        at = np.repeat(np.arange(len(word)), counts)
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        pair = np.repeat(self.starts[word], counts) + inside
        return at, self.queries[pair], self.weights[pair]

    def lengthen(self, n: int) -> int:
        """A document's ``m``."""
        return 100 - 25 + 25 * n * self.documents // self.terms


def _share(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a word that occurs so often adds per unit of weight."""
    return 1_000_000_000 * times // (1000 * times + 12 * m)


class Bounds:
    """Upper bounds of all scores of a slab."""

    def __init__(self, block: Block):
        self.block = block
        self.keys = _keys(block.words)
        self.places: dict[int, np.ndarray] = {}

    def of(self, bits: int, lengths: list[int], rows: bytes) -> np.ndarray:
        """One row per query, one column per document of the slab."""
        block, n = self.block, np.array(lengths, np.int64)
        if bits not in self.places:
            self.places[bits] = _places(self.keys, bits)
        slices = np.frombuffer(rows, np.uint8).reshape(bits, -1)
        m = np.array([block.lengthen(int(x)) for x in lengths], np.int64)
        most = [np.minimum(high - 1, n) for high in LEVELS[1:]] + [n]
        total, below = np.zeros((block.size, len(n))), np.zeros(len(n), np.int64)
        held, words = None, np.arange(len(block.words))
        for level, times in enumerate(most):
            hits = np.bitwise_and.reduce(slices[self.places[bits][words, level]], axis=1)
            if held is not None:
                hits &= held  # what reaches a level reaches the ones below
            some = hits.any(axis=1)
            held, words = hits[some], words[some]
            if not len(words):
                break
            share = _share(times, m)
            word, doc = np.nonzero(np.unpackbits(held, axis=1, count=len(n)))
            at, query, weight = block.spread(words[word])
            added = np.bincount(query * len(n) + doc[at], weight, block.size * len(n))
            total += added.reshape(total.shape) * np.maximum(share - below, 0)
            below = np.maximum(share, below)
        # sums beyond a double's exact integers are raised by more than they can have lost
        return total if block.exact else np.where(total > 0, total * (1 + 1e-9) + 1, 0)


def _slabs(index: DataFrame) -> DataFrame:
    return index.where("term IS NULL").select("bits", "ids", "lengths", "rows")


def _placed(ids: list[int | None]) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in ids], np.int64)


def _id_column(ids: np.ndarray) -> pa.Array:
    return pc.if_else(pa.array(ids == NO_ID), pa.scalar(None, pa.int64()), pa.array(ids))


def _best(query: np.ndarray, ids: np.ndarray, value: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest values of each query, ties to the smaller id."""
    order = np.lexsort((ids, -value, query))
    first = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - first < k]


def highest_bounds(index: DataFrame, block: Block, k: int) -> DataFrame:
    """(q, doc_id) of the ``k`` highest bounds of each query within each task; a task keeps k rows per query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, floor = Bounds(block), np.zeros(block.size)
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        for batch in batches:
            for slab in (r for at in range(batch.num_rows) for r in batch.slice(at, 1).to_pylist()):
                found = bounds.of(slab["bits"], slab["lengths"], slab["rows"])
                query, doc = np.nonzero(found > floor[:, None])
                kept = [np.concatenate(p) for p in zip(kept, (query, _placed(slab["ids"])[doc], found[query, doc]))]
                best = _best(*kept, k)
                kept = [c[best] for c in kept]
                full = np.bincount(kept[0], minlength=block.size) >= k
                least = np.full(block.size, np.inf)
                np.minimum.at(least, kept[0], kept[2])
                floor = np.where(full, least, 0)
        yield pa.RecordBatch.from_arrays([pa.array(kept[0]), _id_column(kept[1]), pa.array(kept[2])],
                                         ["q", "doc_id", "bound"])

    found = _slabs(index).mapInArrow(run, "q long, doc_id long, bound double")
    order = Window.partitionBy("q").orderBy(F.col("bound").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("q", "doc_id")


def not_excluded(index: DataFrame, block: Block, least: np.ndarray, last: np.ndarray) -> DataFrame:
    """(q, doc_id) of all documents whose bound lets them reach ``least``, or tie with it by an id up to ``last``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(block)
        for batch in batches:
            for slab in (r for at in range(batch.num_rows) for r in batch.slice(at, 1).to_pylist()):
                found, ids = bounds.of(slab["bits"], slab["lengths"], slab["rows"]), _placed(slab["ids"])
                reach = (found > least[:, None]) | (
                    (found == least[:, None]) & (ids <= last[:, None]) & (found > 0))
                query, doc = np.nonzero(reach)
                yield pa.RecordBatch.from_arrays([pa.array(query), _id_column(ids[doc])], ["q", "doc_id"])

    return _slabs(index).mapInArrow(run, "q long, doc_id long")


def exact_scores(docs: DataFrame, wanted: DataFrame, block: Block) -> DataFrame:
    """(q, doc_id, score) of the (q, doc_id) pairs in ``wanted``, from the texts; scores above 0.

    ``wanted`` is grouped to one row per document and written, so that Spark knows its size and sends it to the
    documents only if it is small; else both sides are shuffled and a hot id is split by the adaptive join.
    """
    grouped = written(wanted.groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("q").alias("qs")), "candidates")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        grouped, F.col("doc_id").eqNullSafe(F.col("id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(block.words)}
        for batch in batches:
            for part in text_parts(batch, 1):
                row, word, distinct = words_of(part.column(1), SEPARATORS)
                m = np.array([block.lengthen(int(n)) for n in np.bincount(row, minlength=part.num_rows)], np.int64)
                row, word, times = count_pairs(row, word, distinct)
                known = np.array([place.get(w, -1) for w in distinct], np.int64)[word]
                row, word, times = row[known >= 0], known[known >= 0], times[known >= 0]
                at, query, weight = block.spread(word)
                scores = np.zeros((part.num_rows, block.size), np.int64)
                np.add.at(scores, (row[at], query), weight * _share(times, m[row])[at])
                asked = part.column(2)
                of = np.repeat(np.arange(part.num_rows), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
                query = asked.flatten().to_numpy(zero_copy_only=False)
                score = scores[of, query]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query), part.column(0).take(pa.array(of)), pa.array(score)],
                    ["q", "doc_id", "score"]).filter(pa.array(score > 0))

    return texts.select("doc_id", "text", "qs").mapInArrow(run, "q long, doc_id long, score long")


def _top(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, block_size: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0, exactly.

    Documents that repeat are documents of their own; null ids come after all others of their score. Items
    that repeat with the same text are one item, with another text another one. Texts that are null or have no
    term find nothing and are not found; an empty table on either side gives no rows. Other columns are not read.

    All items are searched, ``block_size`` distinct ones at a time; a block's distinct words go to the tasks and must
    fit there, as a row must. A slab has at most ``SLAB_BITS`` bits but for documents above ``LONGEST`` of them, whose
    signatures fill up instead. Index, candidates and results are written to the shared folder, so lost executors
    repeat single tasks. A text is read again only for candidates. A document that repeats a million times is a million
    candidates where its bound reaches the k-th score with a smaller id than the k-th; they are scored by many tasks.
    """
    id_type = items.schema["item_id"].dataType.simpleString()
    index = written(build_index(docs), "signatures")
    totals = index.where("term IS NULL").agg(F.sum("documents").alias("n"), F.sum("terms").alias("l")).first()
    nothing = docs.sparkSession.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    if not totals["n"]:
        return nothing
    asked = query_terms(items)
    lexicon = index.where("term IS NOT NULL").join(asked.select("term").distinct(), "term", "left_semi") \
        .groupBy("term").agg(F.sum("documents").alias("df"))
    priced = written(asked.join(lexicon, "term"), "priced-terms")
    number = priced.select("q").distinct().count()
    blocks = -(-number // block_size)
    path = fresh_path(docs.sparkSession, "ranked")
    for number in range(blocks):
        mine = priced.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == number).collect()
        if not mine:
            continue
        found = _search_block(docs, index, mine, id_type, totals["n"], totals["l"], k)
        found.write.parquet(f"{path}/block={number}")
    return docs.sparkSession.read.schema(nothing.schema).parquet(f"{path}/block=*") if blocks else nothing


def _search_block(docs: DataFrame, index: DataFrame, rows: list, id_type: str, documents: int, terms: int,
                  k: int) -> DataFrame:
    spark = docs.sparkSession
    names = {q: place for place, q in enumerate(sorted({r["q"] for r in rows}))}
    block = Block.of([(names[r["q"]], r["term"], r["times"], r["df"]) for r in rows], len(names), documents, terms)
    first = _top(exact_scores(docs, highest_bounds(index, block, k), block), k).where(F.col("rank") == k)
    least, last = np.zeros(block.size), np.full(block.size, NO_ID)
    for row in first.collect():  # one row per query of the block
        least[row["q"]] = row["score"]
        last[row["q"]] = NO_ID if row["doc_id"] is None else row["doc_id"]
    scores = exact_scores(docs, not_excluded(index, block, least, last), block)
    items = spark.createDataFrame(
        [(place, item) for place, item in sorted({(names[r["q"]], r["item_id"]) for r in rows}, key=lambda p: p[0])],
        f"q long, item_id {id_type}")
    return _top(scores, k).join(F.broadcast(items), "q").select("item_id", "rank", "doc_id", "score")
