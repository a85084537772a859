"""Token counts by heap-and-linked-list byte-pair merging; no token ids are made."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from liftlab.llm.bpe import byte_letters
from liftlab.llm.common import slices

LIMIT = 1024
#: Counts of words that a worker keeps, and the longest word it keeps, in characters.
CACHED_WORDS = 400_000
CACHED_LENGTH = 64
#: Longer texts are split part by part, so that only one part's words are in memory.
PART = 1 << 18

#: Up to this letter the library classes characters as ``regex`` does; other texts are split by the library.
ALIKE_UP_TO = 0x24F


def _classes(*names: str) -> list[str]:
    """The members of Unicode classes up to ``ALIKE_UP_TO``, as the inside of a bracket expression."""
    return ["".join(re.escape(chr(c)) for c in range(ALIKE_UP_TO + 1) if regex.match(name, chr(c))) for name in names]


def _split_pattern() -> re.Pattern:
    """The byte-level split with its classes written out, so that the faster standard engine can run it."""
    letter, digit, space = _classes(r"\p{L}", r"\p{N}", r"\s")
    # Fixed value: how the byte-level vocabularies split text before merging.
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+")


_SPLIT = _split_pattern()
_ALIKE = re.compile(f"[\x00-{chr(ALIKE_UP_TO)}]*")
#: A single space between two letters always starts a word, so a text may be parted there.
_SAFE_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
_PLACE = (1 << 32) - 1


class _Counts(dict):
    """Counts of words; short ones are kept, and all are forgotten once there are ``most``."""

    def __init__(self, count, most: int):
        super().__init__()
        self.count, self.most = count, most

    def __missing__(self, word: str) -> int:
        found = self.count(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= self.most:
                self.clear()
            self[word] = found
        return found


class MergeCounter:
    """Counts the tokens of one byte-level vocabulary file in the tokenizers format."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        if model["type"] != "BPE" or content["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is not a byte-level BPE vocabulary")
        ids, letters = model["vocab"], byte_letters()
        self.symbols = [ids[letters[b]] for b in range(256)]
        # (left, right) as one integer; the merged symbol and its rank as one integer
        self.merges = {
            ids[a] << 32 | ids[b]: rank << 32 | ids[a + b] for rank, (a, b) in enumerate(model["merges"])}
        specials = sorted((t["content"] for t in content["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self._library_split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._known = _Counts(self.word, cached_words)

    def word(self, word: str) -> int:
        """Tokens of one word: its bytes less the merges that join them.

        The pair of the lowest rank, the leftmost of equals, is popped from a heap of rank and place;
        the parts are a linked list, in which the left part of a pair takes the right one's link.
        An entry whose pair has changed since is skipped.
        """
        parts = [self.symbols[b] for b in word.encode()]
        n, of = len(parts), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [merge >> 32 << 32 | i for i in range(n - 1)
                if (merge := of(parts[i] << 32 | parts[i + 1])) is not None]
        heapify(heap)
        left = n
        while heap:
            entry = heappop(heap)
            i = entry & _PLACE
            j = after[i]
            if parts[i] < 0 or j == n:
                continue
            merge = of(parts[i] << 32 | parts[j])
            if merge is None or merge >> 32 != entry >> 32:
                continue
            parts[i], parts[j] = merge & _PLACE, -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if (merge := of(parts[i] << 32 | parts[k])) is not None:
                    heappush(heap, merge >> 32 << 32 | i)
            h = before[i]
            if h >= 0 and (merge := of(parts[h] << 32 | parts[i])) is not None:
                heappush(heap, merge >> 32 << 32 | h)
        return left

    def _part(self, text: str) -> int:
        if _ALIKE.fullmatch(text):
            words = _SPLIT.findall(text)
        else:
            words = [text[a:b] for _, (a, b) in self._library_split(text)]
        return sum(map(self._known.__getitem__, words))

    def _plain(self, text: str) -> int:
        start = found = 0
        while len(text) - start > PART and (cut := _SAFE_CUT.search(text, start + PART)):
            found += self._part(text[start:cut.start()])
            start = cut.start()
        return found + self._part(text[start:] if start else text)

    def text(self, text: str) -> int:
        """Tokens of a text; each special string in it is one."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        found, start = 0, 0
        for match in self.special.finditer(text):
            found += self._plain(text[start:match.start()]) + 1
            start = match.end()
        return found + self._plain(text[start:])


@lru_cache(maxsize=2)
def loaded(path: str) -> MergeCounter:
    """One counter per Python worker and file."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Tokens of every whole text under a byte-level vocabulary, without begin and end tokens; map only.

    Returns (doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``: repeated rows, null
    ids and ties stay rows of their own. A null or empty text has no bytes and no tokens, and is not
    over a limit of 0 or more. Other columns are not read, whatever their names. An empty table gives no rows.
    A worker holds one part of an Arrow batch, the words of at most about ``PART`` characters of a text
    that has spaces between letters, and ``CACHED_WORDS`` counts of short words. A lost task is run again on its own.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(path)
        for batch in batches:
            for part in slices(batch, 256):
                texts = pc.fill_null(part.column(1), "")
                tokens = pa.array([counter.text(t) for t in texts.to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pc.binary_length(texts).cast(pa.int64()), tokens, pc.greater(tokens, limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
