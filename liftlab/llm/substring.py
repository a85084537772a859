"""Substring dedup: Rabin-Karp hashes of all token windows, counted across documents in Spark."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 13
#: Characters of text in one range of documents, the unit that a task hashes.
RANGE_CHARS = 16_000_000
#: Base of the polynomial modulo 2^64 (odd, so it has an inverse), final mixing.
BASE = 0x9E3779B97F4A7C15
MIX = 0xFF51AFD7ED558CCD

_U32 = np.uint64(32)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.multiply.accumulate(steps)


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Rabin-Karp hash of every window of word hashes, from one running sum for all positions."""
    n = len(words)
    if n < window:
        return np.zeros(0, np.uint64)
    down, up = _powers(pow(BASE, -1, 1 << 64), n), _powers(BASE, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * down, out=total[1:])
    rolled = (total[window:] - total[:-window]) * up[:n - window + 1]
    rolled = (rolled ^ (rolled >> _U32)) * np.uint64(MIX)
    return rolled ^ (rolled >> _U32)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


@dataclass
class Windows:
    """All windows of one range of documents, in document order."""

    hashes: np.ndarray
    rank: np.ndarray       # of the window's document; equal ids rank alike
    starts: np.ndarray     # first window of each document, and the end
    words: list            # of each document

    @classmethod
    def of(cls, ids: list, texts: list, window: int) -> Windows:
        order = {v: k for k, v in enumerate(sorted({i for i in ids if i is not None}))}
        words = [(t or "").encode().split() for t in texts]
        each = [window_hashes(word_hashes(w), window) for w in words]
        sizes = np.array([len(e) for e in each], np.int64)
        rank = np.repeat(np.array([order.get(i, -1) for i in ids], np.int64), sizes)
        hashes = np.concatenate(each) if each else np.zeros(0, np.uint64)
        return cls(hashes, rank, np.concatenate([[0], np.cumsum(sizes)]), words)

    def repeats(self, earlier: np.ndarray) -> np.ndarray:
        """Windows that start in an earlier document of this range, or whose hash is in ``earlier``."""
        order = np.lexsort((self.rank, self.hashes))
        h, r = self.hashes[order], self.rank[order]
        if not len(h):
            return np.zeros(0, bool)
        first = np.concatenate([[True], h[1:] != h[:-1]])
        least = r[np.flatnonzero(first)][np.cumsum(first) - 1]
        hit = r > least
        if len(earlier):
            hit |= np.isin(h, earlier)
        out = np.empty(len(h), bool)
        out[order] = hit
        return out


def removed_words(n_words: int, repeated: np.ndarray, window: int) -> np.ndarray:
    """Which words the repeated windows cover, as maximal intervals merged by a running count."""
    edge = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return np.cumsum(edge[:-1]) > 0


def intervals(removed: np.ndarray) -> list[tuple[int, int]]:
    """Maximal [start, end) runs of removed words."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], removed.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _blob(hashes: np.ndarray) -> bytes:
    """Sorted hashes by byte planes: the slowly changing high bytes lie together and compress."""
    return hashes.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unblob(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def remove_repeats(docs: DataFrame, window: int = WINDOW, range_chars: int = RANGE_CHARS) -> DataFrame:
    """(doc_id, n_words, removed, kept): the words left when repeated windows are cut out.

    A word goes if a window of ``window`` words covers it whose words also start in a document
    with a smaller doc_id; windows are judged on the input. ``removed`` lists the maximal
    intervals of removed words, ``kept`` joins the rest by one space.

    Documents are dealt to ranges of doc_id. Each range sends every distinct window hash of its
    own once, packed by hash interval, so a passage that a third of all rows hold arrives as one
    hash per range. The interval tells each range which of its hashes lie in an earlier range.
    Windows are compared by 64-bit hashes. Null text: no words. Rows that repeat a doc_id are one
    document and do not cut each other; a null doc_id comes before all others. Documents of fewer
    words than a window stay whole. An empty table gives no rows; other columns are not read.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // range_chars))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    cuts = sorted(set(cuts or []))
    n = len(cuts) + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [0 if i is None else bisect_left(cuts, i) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], ["range", "doc_id", "text"])

    def send(group: pa.Table) -> pa.Table:
        own = Windows.of(group.column("doc_id").to_pylist(), group.column("text").to_pylist(), window)
        hashes = np.unique(own.hashes)
        borders = np.searchsorted(hashes, np.array([(k << 64) // n for k in range(1, n)], np.uint64))
        parts = [(k, p) for k, p in enumerate(np.split(hashes, borders)) if len(p)]
        here = group.column("range")[0].as_py()
        return pa.table({"part": pa.array([k for k, _ in parts], pa.int32()),
                         "range": pa.array([here] * len(parts), pa.int32()),
                         "hashes": pa.array([_blob(p) for _, p in parts], pa.binary())})

    def count(group: pa.Table) -> pa.Table:
        group = group.sort_by("range")
        ranges = group.column("range").to_numpy()
        each = [_unblob(b.as_buffer()) for b in group.column("hashes").combine_chunks()]
        hashes = np.concatenate(each)
        sender = np.repeat(np.arange(len(each), dtype=np.int32), [len(e) for e in each])
        # a stable order keeps the earliest range first among equal hashes
        order = np.argsort(hashes, kind="stable")
        hashes, sender = hashes[order], sender[order]
        again = np.concatenate([[False], hashes[1:] == hashes[:-1]])
        hashes, sender = hashes[again], sender[again]
        back = [(ranges[s], hashes[sender == s]) for s in np.unique(sender)]
        return pa.table({"range": pa.array([r for r, _ in back], pa.int32()),
                         "hashes": pa.array([_blob(h) for _, h in back], pa.binary())})

    def cut(documents: pa.Table, told: pa.Table) -> pa.Table:
        ids, texts = documents.column("doc_id").to_pylist(), documents.column("text").to_pylist()
        own = Windows.of(ids, texts, window)
        earlier = [_unblob(b.as_buffer()) for b in told.column("hashes").combine_chunks()] if told.num_rows else []
        repeated = own.repeats(np.concatenate(earlier) if earlier else np.zeros(0, np.uint64))
        n_words, removed, kept = [], [], []
        for k, words in enumerate(own.words):
            gone = removed_words(len(words), repeated[own.starts[k]:own.starts[k + 1]], window)
            n_words.append(len(words))
            removed.append([{"from": a, "to": b} for a, b in intervals(gone)])
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words).decode())
        return pa.table({
            "doc_id": documents.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
            "removed": pa.array(removed, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
            "kept": pa.array(kept, pa.string())})

    ranged = docs.select("doc_id", "text").mapInArrow(place, f"range int, doc_id {id_type}, text string") \
        .repartition(n, "range")
    told = ranged.groupBy("range").applyInArrow(send, "part int, range int, hashes binary") \
        .groupBy("part").applyInArrow(count, "range int, hashes binary")
    return ranged.groupBy("range").cogroup(told.groupBy("range")).applyInArrow(
        cut, f"doc_id {id_type}, n_words long, removed array<struct<from:long,to:long>>, kept string")


def digests(cleaned: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of ``remove_repeats``' rows."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda t, i: t + i["to"] - i["from"])
    return cleaned.select("doc_id", "n_words", gone.alias("n_removed"),
                          F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
