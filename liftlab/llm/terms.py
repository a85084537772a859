"""Words of whole Arrow text columns at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text that is cut into words at a time, so that a task's memory does not follow the batch size.
PART_BYTES = 8 << 20


def text_parts(batch: pa.RecordBatch, column: int, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch whose texts take about ``most`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    borders = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for start, end in zip(borders, borders[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def words_of(texts: pa.Array, separators: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(row, word number, distinct words) of all words in order; only A-Z are lower-cased, null has none.

    ``separators`` is the pattern of what lies between words.
    """
    cut = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), separators)
    counts = pc.list_value_length(cut).to_numpy(zero_copy_only=False)
    coded = cut.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    row, word = np.repeat(np.arange(len(texts)), counts), coded.indices.to_numpy(zero_copy_only=False)
    if "" in distinct:  # before the first and after the last separator
        kept = word != distinct.index("")
        row, word = row[kept], word[kept]
    return row, word, distinct


def count_pairs(row: np.ndarray, word: np.ndarray, distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, occurrences) of each distinct pair, sorted."""
    width = max(1, len(distinct))
    keys, times = np.unique(row.astype(np.int64) * width + word, return_counts=True)
    return keys // width, keys % width, times
