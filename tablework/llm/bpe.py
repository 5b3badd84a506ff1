"""Byte-pair encoding and decoding with a pair occurrence index.

A task gathers the texts of its partition up to a byte limit and reduces them
to distinct words. The symbols of all these words lie in one array; an index
maps every rank (an adjacent pair that the vocabulary can merge) to all its
positions. Active ranks are taken in ascending order; all positions of a rank
are merged at once and the lists of the ranks that this creates are extended.
Words already encoded by the same worker are looked up.

Rows: a null text is an empty text; an empty text has no ids and decodes to the
empty text. Very long texts are encoded whole. Equal rows give equal results,
all columns of the input are kept, and a clash with an output name is an error
raised before any work starts.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm import words as W
from tablework.llm.columns import reserve

#: Bytes of text in one pair index. A worker needs some thirty times as much memory while it lasts.
INDEX_BYTES = 2 << 20
#: Words that a worker remembers; beyond it, it starts anew.
KNOWN_WORDS = 300_000

_SPACE = r"\t-\r \x85\xa0  -     　"


def vocabulary_path() -> str:
    """The vocabulary file that is used when none is given."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Encoder:
    """A word-end BPE vocabulary file: lower case, NFC, white space dropped."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.special.items()}
        symbols = _byte_symbols()
        self.first = np.array([vocabulary[s] for s in symbols], np.int64)
        self.last = np.array([vocabulary[s + self.end] for s in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self.left, self.right = left, right
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        keys = left << 20 | right
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        split = split.replace(r"\s", _SPACE)
        self.split = regex.compile(rf"{split}|\n")
        self.specials = regex.compile("|".join(map(regex.escape, self.special)))
        self.known: dict[str, int] = {}
        self.known_ids = np.empty(0, np.uint32)
        self.known_ends = np.zeros(1, np.int64)

    # words

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where the vocabulary has none."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, one after the other, and where each ends."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids = self.first[data]
        ids[ends - 1] = self.last[data[ends - 1]]
        n = len(ids)
        # Links between live symbols; a word's ends link to n, where no pair fits.
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = n
        before[ends - sizes] = n
        ids = np.append(ids, -1)
        alive = np.ones(n + 1, bool)
        alive[n] = False

        at = np.flatnonzero(after < n)
        rank = self.ranks(ids[at], ids[at + 1])
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        starts = np.flatnonzero(np.append(True, rank[1:] != rank[:-1])) if len(rank) else []
        index: dict[int, list[np.ndarray]] = {
            int(rank[s]): [at[s:e]] for s, e in zip(starts, [*starts[1:], len(rank)], strict=True)
        }
        active = list(index)
        heapq.heapify(active)
        while active:
            now = heapq.heappop(active)
            lists = index.pop(now)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[now], self.right[now]
            at = at[alive[at] & (ids[at] == a) & (ids[after[at]] == b)]
            if a == b and len(at) > 1:  # of overlapping positions the leftmost counts
                taken: list[int] = []
                used = -1
                for p in at.tolist():
                    if p != used:
                        taken.append(p)
                        used = int(after[p])
                at = np.array(taken, np.int64)
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            ids[at] = self.merged[now]
            alive[gone] = False
            after[at] = beyond
            inner = beyond < n
            before[beyond[inner]] = at[inner]
            ahead = before[at]
            new_at = np.concatenate([ahead[ahead < n], at[inner]])
            if not len(new_at):
                continue
            new = self.ranks(ids[new_at], ids[after[new_at]])
            fits = new >= 0
            new_at, new = new_at[fits], new[fits]
            if not len(new):
                continue
            if len(new) > 1:
                order = np.argsort(new, kind="stable")
                new_at, new = new_at[order], new[order]
            cut = [0, *(np.flatnonzero(new[1:] != new[:-1]) + 1).tolist(), len(new)]
            for s, e in zip(cut, cut[1:], strict=False):
                r = int(new[s])
                if r in index:
                    index[r].append(np.sort(new_at[s:e]))
                else:
                    index[r] = [np.sort(new_at[s:e])]
                    heapq.heappush(active, r)
        kept = np.flatnonzero(alive[:n])
        return ids[kept].astype(np.uint32), np.searchsorted(kept, ends)

    def learn(self, words: list[str]) -> None:
        """Encode the words that this worker hasn't met."""
        if not words:
            return
        ids, ends = self.merge(words)
        first = len(self.known_ends) - 1
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        self.known_ends = np.concatenate([self.known_ends, self.known_ends[-1] + ends])
        self.known_ids = np.concatenate([self.known_ids, ids])

    # chunks: what stands between white space

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks, one after the other, and where each ends."""
        text = "\n".join(chunks)
        tokens: dict[int, int] = {}
        line_of = None
        if self.specials.search(text):
            text, tokens, line_of = self.cut(chunks)
        pieces = self.split.findall(self.normal(text))
        if len(self.known) > KNOWN_WORDS:
            self.known, self.known_ids, self.known_ends = {}, np.empty(0, np.uint32), np.zeros(1, np.int64)
        known = self.known
        self.learn([w for w in dict.fromkeys(pieces) if w != "\n" and w not in known])
        known["\n"] = -1
        codes = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        del known["\n"]
        breaks = codes < 0
        line = np.cumsum(breaks) - breaks
        line, codes = line[~breaks], codes[~breaks]
        starts, lengths = self.known_ends[codes], np.diff(self.known_ends)[codes]
        ids = self.known_ids[W.spread(starts, lengths)]
        line = np.repeat(line, lengths)
        if tokens:
            at = np.fromiter(tokens, np.int64, len(tokens))
            places = np.searchsorted(line, at)
            ids = np.insert(ids, places, np.fromiter(tokens.values(), np.uint32, len(tokens)))
            line = np.insert(line, places, at)
        if line_of is not None:
            line = line_of[line]
        return ids, np.searchsorted(line, np.arange(len(chunks)), "right")

    def cut(self, chunks: list[str]) -> tuple[str, dict[int, int], np.ndarray]:
        """Chunks with special tokens taken out: their parts get lines of their own.

        Returns the lines, the id of the token that stands on each empty line,
        and the chunk of every line.
        """
        lines: list[str] = []
        tokens: dict[int, int] = {}
        line_of: list[int] = []
        for number, chunk in enumerate(chunks):
            done = 0
            if "<|" in chunk:
                for found in self.specials.finditer(chunk):
                    lines += [chunk[done : found.start()], ""]
                    line_of += [number, number]
                    tokens[len(lines) - 1] = self.special[found.group()]
                    done = found.end()
            lines.append(chunk[done:])
            line_of.append(number)
        return "\n".join(lines), tokens, np.array(line_of, np.int64)

    def encode(self, texts: pa.Array) -> "Encoded":
        offsets, codes, words = W.word_codes(texts)
        ids, ends = self.chunks(words.to_pandas().tolist())
        return Encoded(offsets, codes, ids, ends)

    def text(self, ids: list[int]) -> str:
        """The text of ids: their tokens, with a space between them."""
        return " ".join([self.tokens[i] for i in ids])

    def decode(self, encoded: "Encoded") -> list[str]:
        """The decoded text of each encoded text."""
        names = list(map(self.tokens.__getitem__, encoded.ids.tolist()))
        ends = encoded.ends.tolist()
        spelled = [" ".join(names[s:e]) for s, e in zip([0, *ends], ends, strict=False)]
        full = np.diff(encoded.ends, prepend=0)[encoded.codes] > 0
        offsets = np.concatenate([[0], np.cumsum(full)])[encoded.offsets].tolist()
        codes = encoded.codes[full]
        return [
            " ".join(map(spelled.__getitem__, codes[s:e].tolist()))
            for s, e in zip(offsets, offsets[1:], strict=False)
        ]


class Encoded:
    """Texts as numbers of chunks, and the ids of each chunk."""

    def __init__(self, offsets: np.ndarray, codes: np.ndarray, ids: np.ndarray, ends: np.ndarray):
        self.offsets, self.codes, self.ids, self.ends = offsets, codes, ids, ends

    def raw(self) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        data = self.ids.astype("<u4").tobytes()
        ends = (4 * self.ends).tolist()
        parts = [data[s:e] for s, e in zip([0, *ends], ends, strict=False)]
        offsets = self.offsets.tolist()
        return [
            b"".join(map(parts.__getitem__, self.codes[s:e].tolist()))
            for s, e in zip(offsets, offsets[1:], strict=False)
        ]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The vocabulary at ``path``, loaded once per worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Add ``ids`` (array of int) and ``decoded`` (string) to every row."""
    reserve(df, ["ids", "decoded"])
    path = path or vocabulary_path()
    schema = T.StructType(
        [*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for group in W.gathered(batches, text, INDEX_BYTES):
            encoded = coder.encode(W.texts_of(group, text))
            raw = encoded.raw()
            bounds = np.cumsum([0, *map(len, raw)], dtype=np.int64) // 4
            ids = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
            decoded = pa.array(coder.decode(encoded), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*group.columns, lists, decoded], names=[*group.schema.names, "ids", "decoded"]
            )

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """Add ``decoded`` to rows of ids; null ids decode to the empty text."""
    reserve(df, ["decoded"])
    path = path or vocabulary_path()
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            decoded = [coder.text(v or []) for v in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id`` with the number and digests of its ids and of what they decode to.

    The same encoding as :func:`encode`; only digests leave the task, so that
    ids and decoded texts are neither shuffled nor written.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for group in W.gathered(batches, "text", INDEX_BYTES):
            encoded = coder.encode(W.texts_of(group))
            raw = encoded.raw()
            many = pa.array([len(r) // 4 for r in raw], pa.int64())
            sha = pa.array([hashlib.sha256(r).hexdigest() for r in raw])
            back = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in coder.decode(encoded)])
            yield pa.RecordBatch.from_arrays(
                [group.column("doc_id"), many, sha, back],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select("doc_id", F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def pieces(
    df: DataFrame, size: int, text: str = "text", path: str | None = None, end_id: int = 2
) -> DataFrame:
    """The ids of every text and ``end_id`` after them, cut every ``size`` ids.

    One row per piece: doc_id, start, length, ids_crc32 (of little-endian
    unsigned 32-bit ids) and doc_tokens.
    """
    path = path or vocabulary_path()
    closing = int(end_id).to_bytes(4, "little")

    def cut(coder: Encoder, group: pa.RecordBatch) -> pa.RecordBatch:
        raw = coder.encode(W.texts_of(group)).raw()
        total = np.array([len(r) // 4 + 1 for r in raw], np.int64)
        many = -(-total // size)
        row = np.repeat(np.arange(len(total)), many)
        start = W.spread(np.zeros(len(many), np.int64), many) * size
        length = np.minimum(total[row] - start, size)
        crc = [
            zlib.crc32((raw[r] + closing)[4 * s : 4 * (s + n)])
            for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [
                group.column("doc_id").take(pa.array(row)),
                pa.array(start),
                pa.array(length),
                pa.array(crc, pa.int64()),
                pa.array(total[row]),
            ],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for group in W.gathered(batches, "text", INDEX_BYTES):
            # In a function of its own: nothing of one group is held while the next is encoded.
            yield cut(coder, group)

    return df.select("doc_id", F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    )
