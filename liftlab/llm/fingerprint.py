"""Consistent weighted sampling: document fingerprints whose agreement is the generalised Jaccard likeness."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlab.session import written

SAMPLES = 128
#: Distinct terms whose samples a worker keeps: three 4-byte numbers per sample.
CACHED_TERMS = 60_000
_BLOCK = 512
#: Ranges by number of documents that one range by bytes is put together from.
FINE = 4
# The increments and factors of a 64-bit mixing function.
_STEP, _MIX_A, _MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _MIX_A
    z = (z ^ (z >> np.uint64(27))) * _MIX_B
    return z ^ (z >> np.uint64(31))


def _uniform(bits: np.ndarray, shift: int, width: int) -> np.ndarray:
    """Numbers inside (0, 1) from ``width`` bits."""
    part = (bits >> np.uint64(shift)).astype(np.uint32) & np.uint32((1 << width) - 1)
    return (part.astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -width)


def draw(keys: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per term and sample r ~ Gamma(2, 1), b uniform, and the value log a of a single occurrence.

    With c ~ Gamma(2, 1), a weight w has the level t = floor(log w / r + b) and the value
    log a = log c - r (t - b + 1); the third result is this for t = 0. All come from the term's key.
    """
    place = (np.arange(samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) * _STEP
    one, two = _mixed(keys[:, None] + place), _mixed(keys[:, None] + (place + _STEP))
    r = -(np.log(_uniform(one, 40, 24)) + np.log(_uniform(one, 16, 24)))
    c = -(np.log(_uniform(two, 40, 24)) + np.log(_uniform(two, 16, 24)))
    b = _uniform(one ^ (two << np.uint64(7)), 0, 16)
    return r, b, np.log(c) - r * (1 - b)


class Sampler:
    """Gamma-based samples per weighted term (improved consistent weighted sampling)."""

    def __init__(self, samples: int = SAMPLES, cached: int = CACHED_TERMS):
        self.samples, self.columns = samples, np.arange(samples)
        self.rows: dict[bytes, int] = {}
        self.keys = np.zeros(cached, np.uint64)
        self.r, self.b, self.single = (np.zeros((cached, samples), np.float32) for _ in range(3))

    def _places(self, terms: list[bytes]) -> np.ndarray:
        """Rows of the terms' samples; unknown terms are drawn together."""
        rows = self.rows
        new = [t for t in terms if t not in rows]
        if len(rows) + len(new) > len(self.keys):
            rows.clear()
            new = terms
        if new:
            at = slice(len(rows), len(rows) + len(new))
            keys = np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new))
            self.keys[at] = keys
            self.r[at], self.b[at], self.single[at] = draw(keys, self.samples)
            rows.update(zip(new, range(at.start, at.stop)))
        return np.fromiter(map(rows.__getitem__, terms), np.int64, len(terms))

    def start(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per sample the least value so far, its term's key and the name of (term, level)."""
        return np.full(self.samples, np.inf, np.float32), np.zeros(self.samples, np.uint64), np.zeros(self.samples, np.uint64)

    def add(self, state: tuple, weights: Iterable[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``state`` with more terms. Equal values go to the smaller key, so the order of terms has no effect."""
        best, owner, chosen = state
        weights = list(weights)
        once = [t for t, w in weights if w == 1]
        often = [(t, w) for t, w in weights if w > 1]
        for terms, counts in ((once, None), ([t for t, _ in often], np.array([w for _, w in often], np.float32))):
            for at in range(0, len(terms), _BLOCK):
                rows = self._places(terms[at:at + _BLOCK])
                order = np.argsort(self.keys[rows])  # argmin takes the first of equals
                rows = rows[order]
                log_a, level = self.single[rows], None
                if counts is not None:
                    r = self.r[rows]
                    level = np.floor(np.log(counts[at:at + _BLOCK][order])[:, None] / r + self.b[rows])
                    log_a -= r * level
                least = log_a.argmin(axis=0)
                value, key = log_a[least, self.columns], self.keys[rows][least]
                name = key
                if level is not None:
                    name = key + level[least, self.columns].astype(np.int64).view(np.uint64) * _STEP
                better = (value < best) | (value == best) & (key < owner)
                best, owner, chosen = np.where(better, value, best), np.where(better, key, owner), np.where(better, name, chosen)
        return best, owner, chosen

    @staticmethod
    def named(state: tuple) -> bytes:
        """Two bytes per sample that name the sampled (term, level)."""
        return (_mixed(state[2]) >> np.uint64(48)).astype("<u2").tobytes()

    def fingerprint(self, words: list[bytes]) -> bytes:
        """The fingerprint of a list of words; no words: an empty one."""
        return self.named(self.add(self.start(), Counter(words).items())) if words else b""

    def pair(self, a: Counter[bytes], b: Counter[bytes]) -> tuple[bytes, bytes]:
        """The fingerprints of two weighted sets; terms that both hold equally often are sampled once."""
        shared = a.items() & b.items()
        state = self.add(self.start(), shared)
        return tuple(self.named(self.add(state, own.items() - shared)) if own else b"" for own in (a, b))


@lru_cache(maxsize=2)
def sampler(samples: int) -> Sampler:
    return Sampler(samples)


def likeness(a: bytes, b: bytes) -> float:
    """Share of agreeing samples; two empty fingerprints agree, an empty one is unlike all others."""
    if not a or not b:
        return float(a == b)
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


def edited(text: str, after: str) -> str:
    """The last third of ``text`` replaced by as many characters from the start of ``after``."""
    third = len(text) // 3
    return text[:len(text) - third] + after[:third]


def counted(text: str, other: str, alike: int) -> tuple[Counter[bytes], Counter[bytes]]:
    """Words of two texts whose first ``alike`` characters are the same; whole words of these are counted once."""
    start = max(text.rfind(space, 0, alike) for space in " \t\n\r\x0b\x0c") + 1
    both = Counter(text[:start].encode().split())
    rest = both.copy()
    both.update(text[start:].encode().split())
    rest.update(other[start:].encode().split())
    return both, rest


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprint each whole text and its edited text, and compare it with the next document's.

    Returns (doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next).
    Terms are white-space separated words weighted by their count. Documents follow each other by
    descending doc_id (ties by text, null ids last), and the first follows the last. They are dealt
    to ranges of doc_id; the first document of every range is added to the range before it, so
    one shuffle of the texts is all, and a task holds two documents of its range at a time.
    Null text counts as empty; an empty text's fingerprint is empty, equal to other empty ones
    (likeness 1) and unlike all others (0). A lone document follows itself. An empty table gives
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fine = FINE * n
    cuts = rows.agg(F.percentile_approx("doc_id", [k / fine for k in range(1, fine)], 100 * fine)).first()[0] if fine > 1 else None
    cuts = sorted(set(cuts or []), reverse=True)
    # the number of cuts at or above an id; null ids come last of all
    above = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c >= F.col("doc_id"))) if cuts else F.lit(0)
    placed = rows.withColumn("fine", F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(above))
    heads = written(placed.groupBy("fine").agg(
        F.max(F.struct("doc_id", "text")).alias("head"), F.sum(F.octet_length("text")).alias("bytes")), "heads")
    # neighbouring fine ranges, at most ``fine`` numbers, become ranges of about equal bytes
    sizes = sorted((r.fine, r.bytes) for r in heads.select("fine", "bytes").collect())
    total, so_far, range_of, first = max(1, sum(b for _, b in sizes)), 0, {}, {}
    for number, size in sizes:
        own = min(so_far * n // total, n - 1)
        range_of[number] = own
        first.setdefault(own, number)
        so_far += size
    present = sorted(first)
    numbered = F.create_map(*[F.lit(x) for pair in range_of.items() for x in pair]) if sizes else F.create_map(F.lit(0), F.lit(0))
    ranged = placed.withColumn("range", numbered[F.col("fine")])
    # the first document of a range, added to the range before it
    before = {first[own]: earlier for own, earlier in zip(present, [*present[-1:], *present[:-1]])}
    back = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if present else F.create_map(F.lit(0), F.lit(0))
    extra = heads.select(back[F.col("fine")].alias("range"), F.lit(True).alias("extra"), "head.doc_id", "head.text").where("range IS NOT NULL")
    both = ranged.select("range", F.lit(False).alias("extra"), "doc_id", "text").unionByName(extra) \
        .repartitionById(max(1, n), F.col("range").cast("int")) \
        .sortWithinPartitions("range", "extra", F.col("doc_id").desc_nulls_last(), F.col("text").desc())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, pending, out = sampler(samples), None, None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 7
            made_rows = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            out.clear()
            return made_rows

        def follow(own: bytes) -> None:
            """The document before is done once the fingerprint of its next is known."""
            if pending is not None:
                out.append((*pending, likeness(pending[3], own)))

        for batch in batches:
            types = [batch.schema.field(2).type, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
            for at in range(batch.num_rows):
                extra_row, doc_id, text = (batch.column(c)[at].as_py() for c in (1, 2, 3))
                if held is not None:
                    was_id, was = held
                    new = edited(was, text)
                    own, new_own = made.pair(*counted(was, new, len(was) - len(was) // 3))
                    follow(own)
                    pending = (was_id, len(was), new, own, new_own, likeness(own, new_own))
                held = (doc_id, text)
                if extra_row:  # it only ends its range
                    follow(made.fingerprint(text.encode().split()))
                    held = pending = None
                if len(out) >= 512:
                    yield flush()
            if out:
                yield flush()

    return both.mapInArrow(
        run, f"doc_id {id_type}, n_chars long, edited string, fingerprint binary, "
             "edited_fingerprint binary, near_edited double, near_next double")


def digests(made: DataFrame) -> DataFrame:
    """The contract's columns: the edited text as a digest, the fingerprints in hexadecimal."""
    return made.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
