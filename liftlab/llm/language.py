"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlab.llm.common import held_out, slices

LONGEST = 3
PROFILE = 400
UNKNOWN = "und"

_SPACE = 32
_CODES = 0x110000


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    out = np.zeros(_CODES, bool)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, _CODES)]))
    out[[ord(c) for c in regex.findall(r"\p{L}", text)]] = True
    return out


def spaced(text: str | None) -> np.ndarray:
    """Code points of the lower-case letters of the whole text, one space around and between its words."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), "<u4")
    letter = letters()[codes]
    if not letter.any():
        return codes[:0]
    # a character that is no letter ends a word if a letter comes before it
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    words = np.where(letter, codes, _SPACE)[kept]
    return np.concatenate([[_SPACE], words, [_SPACE] * int(letter[-1])]).astype(np.int64)


def counted(text: str | None, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams of the spaced words, 1 to ``longest`` characters, and their counts.

    A key holds 21 bits for each of three characters, the first in front, so keys sort as the n-grams
    do. A lone space counts for nothing, and no n-gram has a space inside.
    """
    codes = spaced(text)
    if not len(codes):
        return codes, codes
    signs, own = np.unique(codes, return_inverse=True)
    space, keys, counts = int(np.searchsorted(signs, _SPACE)), [], []
    for n in range(1, longest + 1):
        if len(own) < n:
            break
        name, size = np.zeros(len(own) - n + 1, np.int64), len(signs) ** n
        for k in range(n):
            name = name * len(signs) + own[k:len(own) - n + 1 + k]
        if n == 1:
            name = name[own != space]
        elif n > 2:
            inside = np.zeros(len(name), bool)
            for k in range(1, n - 1):
                inside |= own[k:len(name) + k] == space
            name = name[~inside]
        if size <= 4 * len(name) + 50_000:
            count = np.bincount(name, minlength=1)
            found = np.flatnonzero(count)
            count = count[found]
        else:
            found, count = np.unique(name, return_counts=True)
        key = np.zeros(len(found), np.int64)
        for k in range(n):
            sign = signs[found // len(signs) ** (n - 1 - k) % len(signs)]
            key |= (sign + 1) << 21 * (2 - k)
        keys.append(key)
        counts.append(count)
    return np.concatenate(keys), np.concatenate(counts)


def most_frequent(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Keys of the ``size`` most frequent n-grams in order of rank, ties to the smaller one."""
    if len(keys) > size:
        near = counts >= np.partition(counts, len(counts) - size)[len(counts) - size]
        keys, counts = keys[near], counts[near]
    return keys[np.lexsort((keys, -counts))][:size]


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up."""
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


def profiles(docs: DataFrame, longest: int = LONGEST, size: int = PROFILE) -> DataFrame:
    """(lang, gram, place): keys of the ``size`` most frequent n-grams of each language, place from 0.

    Learns from all rows that are not held out and name a language; ties go to the smaller n-gram.
    Tasks send one count per (language, n-gram) of a batch, so a hot language is summed before the shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
            for part in slices(batch, 256):
                found = defaultdict(list)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found[lang].append(counted(text, longest))
                for lang, own in found.items():
                    total[lang] = summed(*zip(*own, *([total[lang]] if lang in total else [])))
            for lang, (keys, counts) in total.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], ["lang", "gram", "n"])

    learn = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("lang").cast("string"), "text")
    found = learn.mapInArrow(count, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return found.withColumn("place", F.row_number().over(ranked) - 1).filter(F.col("place") < size) \
        .select("lang", "gram", "place")


class Ranker:
    """Out-of-place distances of a document's n-grams to each language profile."""

    def __init__(self, rows: list[tuple[str, int, int]], longest: int = LONGEST, size: int = PROFILE):
        self.langs = sorted({lang for lang, _, _ in rows})
        self.size, self.longest = size, longest
        number = {lang: k for k, lang in enumerate(self.langs)}
        self.known = np.unique(np.array([g for _, g, _ in rows], np.int64))
        # an n-gram outside a profile is as far out of place as a profile is long
        self.places = np.full((len(self.known) + 1, len(self.langs)), -1, np.int64)
        for lang, g, place in rows:
            self.places[np.searchsorted(self.known, g), number[lang]] = place

    def predict(self, text: str | None) -> tuple[str, float]:
        keys, counts = counted(text, self.longest)
        if not len(keys) or not self.langs:
            return UNKNOWN, 0.0
        top = most_frequent(keys, counts, self.size)
        row = np.searchsorted(self.known, top)
        row[self.known[np.minimum(row, len(self.known) - 1)] != top] = len(self.known)
        places = self.places[row]
        off = np.where(places >= 0, np.abs(places - np.arange(len(top))[:, None]), self.size).sum(axis=0)
        best = int(off.argmin())
        if len(self.langs) == 1:
            return self.langs[0], 1.0 - float(off[best]) / (self.size * len(top))
        second = float(np.partition(off, 1)[1])
        return self.langs[best], (second - float(off[best])) / second if second else 0.0


def identify(docs: DataFrame, longest: int = LONGEST, size: int = PROFILE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): the language whose profile is nearest in rank order.

    Profiles are learned from ``text`` and ``lang`` of all rows that are not held out; lang, source
    and doc_id are no input of a prediction. The whole text counts. ``score`` is the lead over the
    second nearest language as a share of that one's distance, 0 to 1. A text that is null or has no
    letter is ``und`` with score 0; so is every text if no language was learned. Ties go to the
    smaller language name. Repeated rows and null ids (held out) give a row each; other columns are
    not read. An empty table gives no rows. The profiles, ``size`` rows a language, go to every task.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    learned = [tuple(r) for r in profiles(docs, longest, size).collect()]
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(shared.value, longest, size)
        for batch in batches:
            for part in slices(batch, 512):
                found = [ranker.predict(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")
