"""Arrow and numpy helpers that the text operators run inside tasks.

Words are the runs between the six ASCII white space characters. They are split
and numbered once per slice of a batch; everything else works on the numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at once.
SLICE_BYTES = 4 << 20

MIX = np.uint64(0x9E3779B97F4A7C15)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``limit`` bytes of text, one row at least.

    What Arrow freed meanwhile goes back to the system after every batch: its
    pool would keep it, and Spark's workers outlive their tasks.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()


def gathered(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Like :func:`slices`, but small batches are joined up to the limit as well."""
    held: list[pa.RecordBatch] = []
    size = 0
    for piece in slices(batches, column, limit):
        held.append(piece)
        size += piece.column(column).nbytes
        if size >= limit // 2:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(column), "")


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Offsets per text, the code of each word, and the word of each code."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes, words = flat.indices.to_numpy(), flat.dictionary
    offsets = offsets - offsets[0]
    empty = pc.index(words, "").as_py()
    if empty >= 0:  # left by white space at an end of a text
        keep = codes != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return offsets, codes, words


def hashes(words) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    if not len(words):
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def lower_ascii(word: str) -> str:
    return word.translate(_A_TO_Z)


def bare(word: str) -> str:
    """A word for matching: lower case, without punctuation at its ends."""
    return word.lower().strip(PUNCTUATION)


def scramble(h: np.ndarray) -> np.ndarray:
    """A mixing step, so that sums and products of hashes stay well spread."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of many runs, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


def owners(offsets: np.ndarray) -> np.ndarray:
    """The number of the text each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def distinct_per_owner(
    owner: np.ndarray, values: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, value) in order, with their counts."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return owner[at], values[at], np.diff(np.append(at, len(owner)))


def list_array(owner: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    """One list per owner out of rows sorted by owner."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)
