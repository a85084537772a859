"""Byte-pair encoding and decoding with a contiguous rank array per short word."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlab.llm.common import BoundedCache, slices

#: Words of up to this many bytes are merged by scans of the rank array, longer ones by a heap.
SHORT_WORD = 256
CACHED_WORDS = 300_000
NO_RANK = 1 << 40

#: Fixed value: how the byte-level vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Below this code point the two regular expression engines class all characters alike.
_PLAIN = regex.compile("[\x00-ɏ]*")
_SPLIT = regex.compile(PATTERN)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class RankBPE:
    """Encoder and decoder of one byte-level vocabulary file in the tokenizers format."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        letters = byte_letters()
        self.byte_ids = [model["vocab"][letters[b]] for b in range(256)]
        back = {c: b for b, c in letters.items()}
        self.token_bytes = {i: bytes(back[c] for c in t) for t, i in model["vocab"].items()}
        # one integer per pair of ids; the value holds the rank and the id of the merged part
        self.pairs = {}
        for rank, (a, b) in enumerate(model["merges"]):
            left, right = model["vocab"][a], model["vocab"][b]
            self.pairs[left << 20 | right] = rank << 20 | model["vocab"][a + b]
        self.specials = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.specials.items()}
        self._special = regex.compile(
            "(" + "|".join(regex.escape(t) for t in sorted(self.specials, key=len, reverse=True)) + ")"
        ) if self.specials else None
        # only cuts texts with letters that the installed Unicode tables may class differently
        self._cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._words = BoundedCache(self._word, cached_words)

    def _word(self, word: str) -> bytes:
        parts = [self.byte_ids[b] for b in word.encode()]
        merged = self.merge_short(parts) if len(parts) <= SHORT_WORD else self.merge_long(parts)
        return np.array(merged, "<u4").tobytes()

    def merge_short(self, parts: list[int]) -> list[int]:
        """Scan the ranks of adjacent parts for the (leftmost) minimum until none is left."""
        rank_of = self.pairs.get
        ranks = [rank_of(a << 20 | b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            at = ranks.index(least)
            parts[at] = least & 0xFFFFF
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] << 20 | parts[at + 1], NO_RANK)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] << 20 | parts[at], NO_RANK)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order for words on which repeated scans would be quadratic."""
        rank_of, n = self.pairs.get, len(parts)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 1) for i in range(n - 1)
                if (r := rank_of(parts[i] << 20 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, j = heapq.heappop(heap)
            if not (alive[i] and j < n and alive[j] and after[i] == j
                    and rank_of(parts[i] << 20 | parts[j]) == rank):
                continue
            parts[i], alive[j], after[i] = rank & 0xFFFFF, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank_of(parts[i] << 20 | parts[after[i]])) is not None:
                    heapq.heappush(heap, (r, i, after[i]))
            if before[i] >= 0:
                k = before[i]
                if (r := rank_of(parts[k] << 20 | parts[i])) is not None:
                    heapq.heappush(heap, (r, k, i))
        return [p for p, live in zip(parts, alive) if live]

    def _plain(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text):
            words = _SPLIT.findall(text)
        else:
            words = [text[a:b] for _, (a, b) in self._cut(text)]
        return b"".join(map(self._words.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self._special is None or not self._special.search(text):
            return self._plain(text)
        return b"".join(
            self.specials[part].to_bytes(4, "little") if part in self.specials else self._plain(part)
            for part in self._special.split(text) if part)

    def decode(self, ids: bytes) -> str:
        """The text; bytes that are not UTF-8 become replacement characters. Unknown ids are left out."""
        known = self.token_bytes
        return b"".join(known.get(i, b"") for i in np.frombuffer(ids, "<u4").tolist()).decode(
            "utf-8", errors="replace")


@lru_cache(maxsize=2)
def loaded(path: str) -> RankBPE:
    """One coder per Python worker and file."""
    return RankBPE(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Encode every whole text and decode the ids again; map only, no shuffle.

    Returns (doc_id, ids, decoded): ``ids`` holds little-endian unsigned 32-bit integers. A null
    text counts as empty: no ids and an empty decoded text. Rows that repeat, null ids and ties
    are kept as they are, one row each; other columns are not read. An empty table gives no rows.
    Memory is bounded by one part of an Arrow batch and a cache of ``CACHED_WORDS`` words.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path)
        for batch in batches:
            for part in slices(batch, 256):
                ids = [coder.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()),
                     pa.array([coder.decode(i) for i in ids], pa.string())],
                    ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, ids binary, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``encode_decode``'s rows."""
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
