"""Periodic runs of words, found with a run-length grammar instead of suffix arrays.

A run is a stretch of consecutive words with smallest period q and a length of
at least ``least`` and ``times`` periods that no neighbouring word extends.
For every period the places of a grid, one per stretch that a run of this
period must cover, are candidates where the words a period apart are equal;
extensions to both sides come exactly from the grammar of all texts that a task
holds (see ``recompression``). Grids of all periods of a text of n words have
n log n places, so a run costs a few of them and no pair of places is compared.

Rows: a null or empty text, or one of white space only, has no words and no
runs. A very long text is one grammar; its places are taken in blocks of
``GRID_ROWS``. Equal stretches found from several places or as a multiple of
their smallest period are one run. Repeated rows and repeated ids are worked on
one by one, an empty table gives no rows, and all columns of the input are kept;
a clash with an output name is an error raised before any work starts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm import words as W
from tablework.llm.columns import reserve
from tablework.llm.recompression import grammar

#: Least length of a run in words and in periods.
LEAST, TIMES = 24, 3
#: Places of the grid that are looked at together.
GRID_ROWS = 1 << 20

_RUN = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())]
)


def _grid(
    offsets: np.ndarray, least: int, times: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, place) of all candidates in blocks; places count from 0 over all texts.

    The words a period p apart are equal over at least max(least - p, (times - 1) p)
    places of a run, so one place of a grid of that width lies among them.
    """
    sizes = np.diff(offsets)
    periods = sizes // times
    owner = np.repeat(np.arange(len(sizes)), periods)
    period = W.spread(np.ones(len(sizes), np.int64), periods)
    width = np.maximum(least - period, (times - 1) * period)
    fits = sizes[owner] >= period + width
    owner, period, width = owner[fits], period[fits], width[fits]
    places = -(-(sizes[owner] - period) // width)
    ends = np.cumsum(places)
    start = 0
    while start < len(places):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + GRID_ROWS, "right")))
        many = places[start:stop]
        k = W.spread(np.zeros(stop - start, np.int64), many)
        text = np.repeat(owner[start:stop], many)
        yield text, np.repeat(period[start:stop], many), offsets[text] + k * np.repeat(width[start:stop], many)
        start = stop


def find(
    codes: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start in the text, length and period of all runs, by text, start and period."""
    texts = len(offsets) - 1
    # A symbol of its own stands before, between and after the texts.
    shift = W.owners(offsets) + 1
    symbols = np.empty(len(codes) + texts + 1, np.int64)
    free = int(codes.max(initial=0)) + 1
    borders = offsets + np.arange(texts + 1)
    symbols[borders] = free + np.arange(texts + 1)
    symbols[np.arange(len(codes)) + shift] = codes
    ahead = back = None
    found = [np.empty((0, 4), np.int64)]
    last = len(symbols) - 1
    for text, period, place in _grid(offsets, least, times):
        at = place + text + 1
        keep = np.flatnonzero(symbols[at] == symbols[at + period])
        # A run holds at least four such places on one side; borders differ from everything.
        at, period, text = at[keep], period[keep], text[keep]
        after, before = np.ones(len(at), bool), np.ones(len(at), bool)
        for d in range(1, min(5, least // 4)):
            right, left = np.minimum(at + period + d, last), np.maximum(at - d, 0)
            after &= symbols[np.minimum(at + d, last)] == symbols[right]
            before &= symbols[left] == symbols[np.maximum(at + period - d, 0)]
        keep = after | before
        at, period, text = at[keep], period[keep], text[keep]
        if not len(at):
            continue
        if ahead is None:
            ahead = grammar(symbols, 2 * texts + 16)
            back = ahead.mirrored()
        right = ahead.common(at, at + period)
        left = back.common(last - at + 1, last - (at + period) + 1)
        length = left + period + right
        keep = length >= np.maximum(least, times * period)
        start = at - left - borders[text] - 1
        rows = np.stack([text, start, length, period], 1)[keep]
        found.append(_smallest(rows))
    rows = _smallest(np.concatenate(found))
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]


def _smallest(rows: np.ndarray) -> np.ndarray:
    """One row per stretch, with its smallest period."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def kept(offsets: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words lie in no run after its first period."""
    depth = np.zeros(int(offsets[-1]) + 1, np.int64)
    begin = offsets[text] + start
    np.add.at(depth, begin + period, 1)
    np.add.at(depth, begin + length, -1)
    return np.cumsum(depth)[:-1] == 0


def _joined(words: np.ndarray, codes: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> list[str]:
    bounds = np.concatenate([[0], np.cumsum(keep)])[offsets].tolist()
    chosen = words[codes[keep]].tolist()
    return [" ".join(chosen[s:e]) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]


def collapse(df: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``df`` with ``runs`` (start, length, period in words) and ``collapsed``, the text with one period of each run.

    Kept words are joined by one space. ``least`` must be at least 8 and ``times`` at least 2.
    """
    if least < 8 or times < 2:
        raise ValueError("a run has at least 8 words and 2 periods")
    reserve(df, ["runs", "collapsed"])
    schema = T.StructType(
        [*df.schema.fields, T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.slices(batches, text):
            offsets, codes, names = W.word_codes(W.texts_of(piece, text))
            owner, start, length, period = find(codes, offsets, least, times)
            keep = kept(offsets, owner, start, length, period)
            fields = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], names=_RUN.names)
            texts = _joined(np.array(names.to_pylist(), object), codes, offsets, keep)
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, W.list_array(owner, fields, piece.num_rows), pa.array(texts, pa.string())],
                names=[*piece.schema.names, "runs", "collapsed"],
            )

    return df.mapInArrow(run, schema)


def _crc(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def wrap(codes: np.ndarray, offsets: np.ndarray, ids: list[int | None]) -> np.ndarray:
    """Every tenth text by the crc32 of its id made periodic from some word on."""
    codes = codes.copy()
    for i, doc_id in enumerate(ids):
        h, n, base = _crc(doc_id), int(offsets[i + 1] - offsets[i]), int(offsets[i])
        if h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        codes[base + a : base + n] = codes[base + a + np.arange(n - a) % p]
    return codes


_DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def digests(df: DataFrame, text: str = "text") -> DataFrame:
    """Runs of all texts, every tenth made periodic first, with their strongest run and digests.

    The strongest run has the greatest length over period; of equal ones the
    first start, then the smallest period.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.slices(batches, "text"):
            offsets, codes, names = W.word_codes(W.texts_of(piece))
            ids = piece.column("doc_id").to_pylist()
            codes = wrap(codes, offsets, ids)
            owner, start, length, period = find(codes, offsets)
            texts = _joined(np.array(names.to_pylist(), object), codes, offsets, kept(offsets, owner, start, length, period))
            bounds = np.searchsorted(owner, np.arange(len(ids) + 1)).tolist()
            runs = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
            rows = []
            for i, doc_id in enumerate(ids):
                own = runs[bounds[i] : bounds[i + 1]]
                best = max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if own else (None,) * 3
                milli = 1000 * best[1] // best[2] if own else None
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in own)
                rows.append((doc_id, len(own), *best, milli, *(hashlib.sha256(t.encode()).hexdigest() for t in (listed, texts[i]))))
            yield pa.RecordBatch.from_pydict(
                {
                    name: pa.array(column, pa.string() if name.endswith("sha256") else pa.int64())
                    for name, column in zip(
                        ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
                        zip(*rows, strict=True),
                        strict=True,
                    )
                }
            )

    return df.select("doc_id", F.col(text).alias("text")).mapInArrow(run, _DIGESTS)
