"""Sum-of-squares packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlab.llm.bpe import byte_letters
from liftlab.llm.common import slices

LENGTH = 4096
END_ID = 2
#: Tokens per fill level; a window with less room than this is topped up and closed.
LEVEL = 64
#: Expected documents of one shard, the unit that one task packs.
SHARD_DOCS = 8192
#: Words that a worker keeps, and half the runs of letters; about 150 bytes each; fewer are forgotten and learnt again more often.
CACHED_WORDS = 700_000

PIECES = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class WordTokens:
    """Ids of a vocabulary that never joins letters across white space and marks the ends of words.

    Such a text's ids are those of its words in turn, so a worker encodes each new word once. A word
    of Latin letters and closing marks is taken apart, and new runs of letters are encoded together
    in one text, whose ids are cut again at the tokens that end a word.
    """

    #: A line of lower-case letters that stay one code point each when composed, then closing marks; or any line.
    SIMPLE = re.compile("^([a-zß-öø-ÿ]*)([.,;:!?]*)$|^.*$", re.MULTILINE)

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        # the same merges without the steps that runs of letters or marks have behind them
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        content |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.merger = Tokenizer.from_str(json.dumps(content))
        self.letters = {b: c for b, c in byte_letters().items() if b != ord(" ")}
        names = self.coder.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.most = cached_words

    def encode(self, texts: list[str]) -> list[bytes]:
        gc.disable()  # nothing here is cyclic, and the collector would look at each new pair of parts
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = [t.encode().split() for t in texts]
        found = set().union(*cut)
        new = list(filterfalse(self.words.__contains__, found))
        if len(self.words) + len(new) > self.most:
            self.words.clear()
            new = list(found)
        self._learn(new)
        look = self.words.__getitem__
        return [b"".join(map(look, c)) for c in cut]

    def _learn(self, words: list[bytes]) -> None:
        if not words:
            return
        runs, parts = self.runs, self.SIMPLE.findall(b"\n".join(words).decode().lower())
        used = {r for p in parts for r in p}
        need = list(filterfalse(runs.__contains__, used))
        if len(runs) + len(need) > 2 * self.most:
            runs.clear()
            need = list(used)
        self._learn_runs([r for r in need if r])
        runs[""] = b""
        odd = [w for w, p in zip(words, parts) if not any(p)]
        self.words.update((w, runs[p[0]] + runs[p[1]]) for w, p in zip(words, parts))
        self.words.update(zip(odd, self._whole([w.decode() for w in odd])))

    def _learn_runs(self, runs: list[str]) -> None:
        for at in range(0, len(runs), 5_000):
            part = runs[at:at + 5_000]
            text = " ".join(part).encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.merger.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            borders = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(borders) == len(part):
                whole = ids.tobytes()
                self.runs.update(zip(part, map(whole.__getitem__, map(slice, [0, *borders], borders))))
            else:  # a vocabulary that cuts a run of letters
                self.runs.update(zip(part, self._whole(part)))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.coder.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def loaded(path: str) -> WordTokens:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokens(path)


def tokenised(docs: DataFrame, path: str, length: int, shards: int, end_id: int) -> DataFrame:
    """(shard, doc_id, full, tail): checks of the document's full pieces and the ids of its rest."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = loaded(path), end_id.to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, 512):
                full, tail = [], []
                for ids in coder.encode([t or "" for t in part.column(2).to_pylist()]):
                    ids += end
                    whole = len(ids) // (4 * length) * 4 * length
                    full.append([zlib.crc32(ids[i:i + 4 * length]) for i in range(0, whole, 4 * length)])
                    tail.append(ids[whole:])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(full, pa.list_(pa.int64())),
                     pa.array(tail, pa.binary())], ["shard", "doc_id", "full", "tail"])

    shard = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(shards))
    return docs.select(shard.alias("shard"), "doc_id", "text").mapInArrow(
        run, f"shard long, doc_id {id_type}, full array<long>, tail binary")


class LevelArray:
    """Open windows by fill level; ``counts`` is the level array that decides each placement."""

    def __init__(self, length: int, unit: int):
        self.length, self.unit = length, unit
        self.levels = -(-length // unit)
        self.counts = np.zeros(self.levels, np.int64)
        self.open: list[list[list]] = [[] for _ in range(self.levels)]

    def choose(self, size: int) -> int:
        """The level whose window takes ``size`` tokens with the least sum of squared counts; -1: a new one."""
        counts, best = self.counts, -1
        least = 2 * counts[size // self.unit] + 1 if self.length - size >= self.unit else 0
        for level in np.flatnonzero(counts):
            fill = self.open[level][-1][0] + size
            if fill > self.length:
                break
            to = fill // self.unit
            # a window that is all but full is closed, so its level gains nothing
            gain = 0 if self.length - fill < self.unit else 2 * counts[to] + 1
            cost = gain - 2 * counts[level] + 1 if to != level else 0
            if cost < least:
                best, least = int(level), cost
        return best

    def take(self, level: int) -> list:
        self.counts[level] -= 1
        return self.open[level].pop()

    def put(self, window: list) -> None:
        level = window[0] // self.unit
        self.counts[level] += 1
        self.open[level].append(window)


def pack(sizes: list[int], length: int = LENGTH, unit: int = LEVEL) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start, size) for items of fewer than ``length`` tokens, in their order.

    Each item goes whole to the fill level that minimises the sum of squared counts of open
    windows. A window with room for less than ``unit`` tokens is topped up with the head of the
    next item. What is open at the end is cut anew: full windows, then one window for each power
    of two of what remains, so that no window needs padding.
    """
    levels, done, waiting = LevelArray(length, unit), [], None
    for item, size in enumerate(sizes):
        start = 0
        if waiting is not None and size:
            room = length - waiting[0]
            start = min(room, size)
            waiting[1].append((item, 0, start))
            waiting[0] += start
            if waiting[0] < length:
                continue
            done.append(waiting[1])
            waiting = None
        size -= start
        if not size:
            continue
        level = levels.choose(size)
        window = [0, []] if level < 0 else levels.take(level)
        window[1].append((item, start, size))
        window[0] += size
        if window[0] == length:
            done.append(window[1])
        elif length - window[0] < unit:
            waiting = window
        else:
            levels.put(window)
    rest = [p for level in levels.open for w in level for p in w[1]] + (waiting[1] if waiting else [])
    left = sum(p[2] for p in rest)
    targets = [length] * (left // length)
    left %= length
    targets += [1 << b for b in range(length.bit_length(), -1, -1) if left >> b & 1]
    rest.reverse()
    for target in targets:
        window = []
        while target:
            item, start, size = rest.pop()
            used = min(size, target)
            window.append((item, start, used))
            target -= used
            if used < size:
                rest.append((item, start + used, size - used))
        done.append(window)
    return done


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID,
                   unit: int = LEVEL, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Tokenise whole documents and pack them into sequences of ``length`` ids; one row per piece.

    Documents are dealt to shards by a hash, about ``shard_docs`` each; a shard numbers its own
    sequences. Only the rest of a document, fewer than ``length`` ids, travels to its shard, so
    neither a very long text nor a hot source makes a task large. A null or empty text is the end
    id alone. Repeated rows and null ids are packed as documents of their own. An empty table
    gives no rows; other columns are not read. A sequence is full, or its length is a power of two.
    """
    if length & (length - 1) or length < 2 * unit:
        raise ValueError("length must be a power of two and hold two levels at least")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shards = max(1, -(-docs.count() // shard_docs))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("tail", "ascending")])
        shard = group.column("shard")[0].as_py()
        ids, full, tails = (group.column(c).to_pylist() for c in ("doc_id", "full", "tail"))
        doc_tokens = [len(f) * length + len(t) // 4 for f, t in zip(full, tails)]
        out, sequence = [], shard << 32
        for doc, checks in enumerate(full):
            for k, check in enumerate(checks):
                out.append((doc, k * length, length, check, sequence, 0))
                sequence += 1
        order = np.random.default_rng(shard).permutation(len(ids)).tolist()
        for window in pack([len(tails[d]) // 4 for d in order], length, unit):
            offset = 0
            for item, start, size in window:
                doc = order[item]
                piece = tails[doc][4 * start:4 * (start + size)]
                out.append((doc, len(full[doc]) * length + start, size, zlib.crc32(piece), sequence, offset))
                offset += size
            sequence += 1
        doc, start, size, check, number, offset = (
            np.array(c, np.int64) for c in zip(*out)) if out else [np.zeros(0, np.int64)] * 6
        return pa.table({
            "doc_id": group.column("doc_id").take(pa.array(doc)), "start": start, "length": size,
            "ids_crc32": check, "doc_tokens": np.array(doc_tokens, np.int64)[doc],
            "sequence_id": number, "offset": offset})

    return tokenised(docs, path, length, shards, end_id).groupBy("shard").applyInArrow(
        run, PIECES.format(id=id_type))
