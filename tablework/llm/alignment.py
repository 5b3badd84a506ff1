"""Alignment of the tokens that two tokenizers make of the same bytes.

A is a byte-level BPE file of the tokenizers library, B a sentencepiece model
that adds a space in front; both see a space and the text. Offsets where tokens
of both end cut them into groups; an A token and a B token whose bytes overlap
are a link. A link's count is how many links of the whole corpus hold its pair
of ids.

The identity map gives every A id the B id of the same bytes. Groups of one
such pair are counted in a vector over A's ids; only links of other groups are
shuffled as pairs, once per slice of about ``words.SLICE_BYTES`` of text and
with their number of occurrences. So a frequent pair has one row per slice, not
one per document. Slices are written to the shared folder; the counts of their
pairs come back to them by slice, and per-id vectors (at most one number per
vocabulary entry) are broadcast.

A worker remembers chunks in Arrow and numpy arrays of bounded bytes, and a
slice travels compressed in rows of ``PART_BYTES``, so memory depends neither on
the corpus nor on the length of chunks, but on the largest slice.

Neither tokenizer joins a space to what stands before it, so texts are cut
before single spaces that a visible ASCII character or letter follows, and each
distinct chunk of a slice is tokenized and aligned once. Vocabularies for which
this can't be shown get whole texts.

Rows: a null or empty text, or one whose tokens don't spell its bytes, has no
tokens: zeros and an empty text of groups. A very long text is a slice of its
own. Of ties for the highest count of a B id every pair is best. Repeated rows
and ids are worked on one by one and count as often as they occur, an empty table gives no
rows, and other columns are kept by ``align``, where a clash with an output
name is an error raised before any work starts; the other functions don't
return them.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm import words as W
from tablework.llm.bpe import _byte_symbols
from tablework.llm.columns import reserve
from tablework.runtime import scratch_path

#: Bytes of what a worker remembers of chunks; beyond it, it starts anew.
KNOWN_BYTES = 40 << 20
#: Chunks handed to the tokenizers at once.
TOGETHER = 4_000
#: A pair of ids as one number: A's id times this plus B's.
PAIR = 1 << 24
#: Bytes of a slice in a row. Rows of megabytes are objects that the JVM can't move, and its heap grows to the limit.
PART_BYTES = 256 << 10
#: Bytes of a row group of the written slices.
GROUP_BYTES = 4 << 20

_SAFE = regex.compile(r"^[!-~\p{L}]")
#: Signs that both libraries for A's vocabulary class alike.
_LATIN = regex.compile(r"[\x00-\x7f\xa0-\u024f]*")
_MARK = "▁"

# Fixed value: how byte-level vocabularies of this family cut a text into words.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_paths() -> tuple[str, str]:
    """The two vocabulary files that are used when none are given."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _joined(parts: pa.Array, ends: np.ndarray, sign: str) -> pa.Array:
    """The parts between neighbouring ends as one text each."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), parts), pa.scalar(sign, pa.large_string()))


class Store:
    """What is known of each chunk, as growing arrays; the row of a chunk is its place in them."""

    def __init__(self):
        self.chunks = [pa.array([], pa.large_string())]
        self.spelled = [pa.array([], pa.large_string())]
        self.numbers = [np.empty((0, 4), np.int64)]
        self.pairs = [np.empty(0, np.int64)]
        self.same = [np.empty(0, np.int64)]
        self.pair_ends = [np.zeros(1, np.int64)]
        self.same_ends = [np.zeros(1, np.int64)]

    def whole(self, name: str) -> np.ndarray | pa.Array:
        parts = getattr(self, name)
        if len(parts) > 1:
            parts[:] = [pa.concat_arrays(parts) if isinstance(parts[0], pa.Array) else np.concatenate(parts)]
        return parts[0]

    def size(self) -> int:
        return sum(part.nbytes for parts in vars(self).values() for part in parts)


class Aligner:
    """Both tokenizers, the bytes of their ids, the identity map and the chunks seen so far."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as file:
            spec = json.load(file)
        # One thread per task; the cluster spreads the work.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = {s: bytes([i]) for i, s in enumerate(_byte_symbols())}
        self.a_bytes = []
        for i in range(self.a.get_vocab_size()):
            token = self.a.id_to_token(i) or ""
            plain = all(c in letters for c in token)
            self.a_bytes.append(b"".join(letters[c] for c in token) if plain else token.encode())
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(_MARK, " ").encode())
        self.a_length = np.array([len(t) for t in self.a_bytes])
        self.b_length = np.array([len(t) for t in self.b_bytes])
        of_bytes: dict[bytes, int] = {}
        for i, piece in enumerate(self.b_bytes):
            if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i)):
                of_bytes.setdefault(piece, i)
        self.same_id = np.array([of_bytes.get(t, -1) for t in self.a_bytes])
        self.cuts = self._may_cut(spec)
        self.ranks = self._by_rank(spec)
        self.spelling = pa.array(map(str, range(max(len(self.a_bytes), len(self.b_bytes)))), pa.large_string())
        self.store = Store()

    def _may_cut(self, spec: dict) -> bool:
        """Whether no token of either can hold a space after something else."""
        before = spec.get("pre_tokenizer") or {}
        known = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not spec.get("normalizer")
        pieces = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        return bool(known) and not any(_MARK in p.lstrip(_MARK) for p in pieces) and self.b.encode(" a  b") == self.b.encode(
            " a "
        ) + self.b.encode("b")

    def _by_rank(self, spec: dict):
        """A's vocabulary for the faster library, if its ids are the ranks of its merges; used for Latin texts only."""
        import tiktoken

        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ids = [spec["model"]["vocab"].get("".join(m), -1) for m in merges]
        special = {t["id"] for t in spec.get("added_tokens") or []}
        letters = len(ids) and min(ids) == 256 and ids == list(range(256, 256 + len(ids)))
        if not (self.cuts and letters):
            return None
        ranks = {raw: i for i, raw in enumerate(self.a_bytes) if i not in special}
        return tiktoken.Encoding("ranks", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Offsets per text, the code of each chunk, and the chunk of each code; no empty text has any."""
        if not self.cuts:
            flat = texts.dictionary_encode()
            codes, named = flat.indices.to_numpy(), flat.dictionary.cast(pa.large_string())
            filled = pc.greater(pc.binary_length(named), 0).to_numpy(zero_copy_only=False)
            keep = filled[codes] if len(codes) else np.zeros(0, bool)
            return np.concatenate([[0], np.cumsum(keep)]), codes[keep], named
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        codes, named = flat.indices.to_numpy().astype(np.int64), flat.dictionary.cast(pa.large_string())
        starts_safe = pc.match_substring_regex(named, _SAFE.pattern).to_numpy(zero_copy_only=False)
        safe = starts_safe[codes] if len(codes) else np.zeros(0, bool)
        unsafe = np.concatenate([[0], np.cumsum(~safe)])
        odd = np.flatnonzero(unsafe[offsets[1:]] > unsafe[offsets[:-1]])
        if not len(odd):
            return offsets, codes, named
        # Texts with other spaces or signs: join what may not be cut.
        lists_of = np.split(codes, offsets[1:-1]) if len(offsets) > 1 else []
        fresh: list[pa.Array] = []
        for i in odd.tolist():
            parts = named.take(pa.array(lists_of[i])).to_pylist()
            fine = safe[offsets[i] : offsets[i + 1]].tolist()
            joined: list[str] = []
            for at, part in enumerate(parts):
                if at == 0 or (fine[at] and parts[at - 1]):
                    joined.append(part)
                else:
                    joined[-1] += " " + part
            if joined == [""]:
                joined = []
            fresh.append(pa.array(joined, pa.large_string()))
        every = pa.concat_arrays(fresh)
        found = pc.index_in(every, value_set=named)
        others = every.filter(pc.is_null(found)).dictionary_encode()
        number = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        number[number < 0] = others.indices.to_numpy() + len(named)
        ends = np.cumsum([len(f) for f in fresh])
        for i, own in zip(odd.tolist(), np.split(number, ends[:-1]), strict=True):
            lists_of[i] = own
        sizes = [len(c) for c in lists_of]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return offsets, np.concatenate(lists_of), pa.concat_arrays([named, others.dictionary])

    def known(self, chunks: pa.Array) -> np.ndarray:
        """The store's row of each of these different chunks; new ones are tokenized and aligned."""
        if self.store.size() > KNOWN_BYTES:
            self.store = Store()
        found = pc.index_in(chunks, value_set=self.store.whole("chunks"))
        rows = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        fresh = np.flatnonzero(rows < 0)
        last = len(self.store.whole("chunks"))
        for at in range(0, len(fresh), TOGETHER):
            of = fresh[at : at + TOGETHER]
            some = chunks.take(pa.array(of)).to_pylist()
            # Chunks that may stand behind each other are tokenized as one text.
            kind = np.array(
                [(1 if _LATIN.fullmatch(c) else 2) if self.cuts and _SAFE.match(c) and not c.endswith(" ") else 3 for c in some]
            )
            for k in (1, 2, 3):
                own = np.flatnonzero(kind == k)
                if len(own):
                    part = [some[i] for i in own.tolist()]
                    self._add(part, *((self._together(part, k == 1) if k < 3 else None) or self._alone(part)))
                    rows[of[own]] = np.arange(last, last + len(own))
                    last += len(own)
        return rows

    def _together(self, chunks: list[str], plain: bool) -> tuple | None:
        """Tokens of all chunks from one text, and their bytes; None if they don't spell it."""
        text = " ".join(chunks)
        if plain and self.ranks is not None:
            a = self.ranks.encode_ordinary(" " + text)
        else:
            a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        raw = (" " + text).encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        sizes = np.array([len(c.encode()) + 1 for c in chunks])
        return np.array(a, np.int64), np.array(b, np.int64), sizes, [True] * len(chunks)

    def _alone(self, chunks: list[str]) -> tuple:
        """The same chunk by chunk; one whose tokens don't spell it has none."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        b = self.b.encode(chunks, num_threads=1)
        fine = []
        for chunk, x, y in zip(chunks, a, b, strict=True):
            raw = b" " + chunk.encode()
            fine.append(
                b"".join([self.b_bytes[i] for i in y]) == raw and b"".join([self.a_bytes[i] for i in x]) == raw
            )
        a_id = np.array([i for x, good in zip(a, fine, strict=True) if good for i in x], np.int64)
        b_id = np.array([i for y, good in zip(b, fine, strict=True) if good for i in y], np.int64)
        sizes = np.array([len(c.encode()) + 1 if good else 0 for c, good in zip(chunks, fine, strict=True)])
        return a_id, b_id, sizes, fine

    def _add(self, chunks: list[str], a_id: np.ndarray, b_id: np.ndarray, sizes: np.ndarray, fine: list[bool]) -> None:
        store = self.store
        a_at, b_at = np.cumsum(self.a_length[a_id]), np.cumsum(self.b_length[b_id])
        bytes_at = np.concatenate([[0], np.cumsum(sizes)])
        a_ends, b_ends = np.searchsorted(a_at, bytes_at, "right"), np.searchsorted(b_at, bytes_at, "right")
        every = np.sort(np.concatenate([a_at, b_at]), kind="stable")
        twice = np.concatenate([every[1:] == every[:-1], [False]])[: len(every)]
        both, every = every[twice], every[~twice]
        # Every stretch between neighbouring ends is one link.
        link_a, link_b = a_id[np.searchsorted(a_at, every)], b_id[np.searchsorted(b_at, every)]
        group_a, group_b = np.searchsorted(a_at, both, "right"), np.searchsorted(b_at, both, "right")
        first_a, first_b = np.concatenate([[0], group_a])[:-1], np.concatenate([[0], group_b])[:-1]
        single = (group_a - first_a == 1) & (group_b - first_b == 1)
        single[single] = self.same_id[a_id[first_a[single]]] == b_id[first_b[single]]
        same = single[np.searchsorted(both, every)]
        # Where the chunks end among links and groups.
        link_ends = np.searchsorted(every, bytes_at, "right")
        group_ends = np.searchsorted(both, bytes_at, "right")
        numbers = np.stack([np.diff(a_ends), np.diff(b_ends), np.diff(group_ends), np.diff(link_ends)], 1)
        groups = pc.binary_join_element_wise(
            _joined(self.spelling.take(pa.array(a_id)), np.concatenate([[0], group_a]), ","),
            _joined(self.spelling.take(pa.array(b_id)), np.concatenate([[0], group_b]), ","),
            pa.scalar("|", pa.large_string()),
        )
        spelled = _joined(groups, group_ends, ";")
        store.chunks.append(pa.array(chunks, pa.large_string()))
        store.spelled.append(pc.if_else(pa.array(fine), spelled, pa.scalar(None, pa.large_string())))
        store.numbers.append(numbers)
        same_before = np.concatenate([[0], np.cumsum(same)])[link_ends]
        last_pair, last_same = store.pair_ends[-1][-1], store.same_ends[-1][-1]
        store.pairs.append((link_a * PAIR + link_b)[~same])
        store.same.append(link_a[same])
        store.pair_ends.append(last_pair + (link_ends - same_before)[1:])
        store.same_ends.append(last_same + same_before[1:])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    """One pair of tokenizers per worker process."""
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


class Slice:
    """The chunks of some texts, and per text its numbers and groups."""

    def __init__(self, tool: Aligner, texts: pa.Array):
        offsets, codes, chunks = tool.chunks(texts)
        held = np.zeros(len(chunks), bool)
        held[codes] = True
        codes = (np.cumsum(held) - 1)[codes]
        self.rows = tool.known(chunks.filter(pa.array(held)))
        self.store = tool.store
        names = self.store.whole("spelled").take(pa.array(self.rows))
        wrong = pc.is_null(names).to_numpy(zero_copy_only=False)
        owner = W.owners(offsets)
        good = np.ones(len(texts), bool)
        good[owner[wrong[codes]]] = False
        keep = good[owner]
        self.good, self.codes, self.owner = good, codes[keep], owner[keep]
        numbers = self.store.whole("numbers")[self.rows]
        self.numbers = np.stack(
            [np.bincount(self.owner, numbers[self.codes, k], len(texts)).astype(np.int64) for k in range(4)], 1
        )
        bounds = np.searchsorted(self.owner, np.arange(len(texts) + 1))
        self.groups = _joined(names.take(pa.array(self.codes)), bounds, ";")

    def flat(self, what: str, ends: str) -> tuple[np.ndarray, np.ndarray]:
        """How many values of the store each chunk has, and the values."""
        values, ends_of = self.store.whole(what), self.store.whole(ends)
        start = ends_of[self.rows]
        many = ends_of[self.rows + 1] - start
        return many, values[W.spread(start, many)]


def align(df: DataFrame, text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """``df`` with n_a, n_b, n_groups, n_links and ``groups``, the ids of each group as text."""
    names = ["n_a", "n_b", "n_groups", "n_links"]
    reserve(df, [*names, "groups"])
    paths = paths or tokenizer_paths()
    added = [*(T.StructField(n, T.LongType()) for n in names), T.StructField("groups", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.slices(batches, text):
            found = Slice(aligner(paths), W.texts_of(piece, text))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, *(pa.array(found.numbers[:, k]) for k in range(4)), found.groups.cast(pa.string())],
                names=[*piece.schema.names, *names, "groups"],
            )
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added]))


_SLICES = "slice long, part int, body binary, pairs array<long>, pair_times array<long>, same array<long>, same_times array<long>"
_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _packed(lists: dict[str, pa.Array | np.ndarray]) -> memoryview:
    """Arrays of any lengths as compressed bytes; ids and numbers of a slice have 32 bits."""
    values = {k: v if isinstance(v, pa.Array) else pa.array(v.astype(np.uint32)) for k, v in lists.items()}
    row = pa.RecordBatch.from_pydict({k: pa.LargeListArray.from_arrays(pa.array([0, len(v)], pa.int64()), v) for k, v in values.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(row)
    return memoryview(sink.getvalue())


def _unpacked(body: bytes) -> dict[str, pa.Array]:
    row = pa.ipc.open_stream(body).read_next_batch()
    return {name: row.column(name).flatten() for name in row.schema.names}


def _sha256(groups: pa.Array) -> list[str]:
    """The digest of each text, nothing for an empty one; the bytes aren't copied."""
    _, ends, raw = groups.buffers()
    ends = np.frombuffer(ends, np.int64)[groups.offset : groups.offset + len(groups) + 1].tolist()
    raw = memoryview(raw or b"")
    return [hashlib.sha256(raw[s:e]).hexdigest() if e > s else "" for s, e in zip(ends[:-1], ends[1:], strict=True)]


def slices_of(df: DataFrame, text: str, paths: tuple[str, str]) -> DataFrame:
    """Rows with parts of slices of texts: documents, chunks and links in ``body``; the first part also has the summed pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, piece in enumerate(W.gathered(batches, "text")):
            body, sums = sliced(piece)
            for part, at in enumerate(range(0, len(body), PART_BYTES)):
                yield pa.RecordBatch.from_pydict(
                    {
                        "slice": pa.array([first + number], pa.int64()),
                        "part": pa.array([part], pa.int32()),
                        "body": pa.array([bytes(body[at : at + PART_BYTES])], pa.binary()),
                        **{name: pa.array([[] if part else values], pa.list_(pa.int64())) for name, values in sums.items()},
                    }
                )
            pa.default_memory_pool().release_unused()

    def sliced(piece: pa.RecordBatch) -> tuple[memoryview, dict[str, np.ndarray]]:
        found = Slice(aligner(paths), W.texts_of(piece))
        owner, code, times = W.distinct_per_owner(found.owner, found.codes)
        chunks = np.bincount(owner, minlength=piece.num_rows)
        weight = np.bincount(code, times, len(found.rows)).astype(np.int64)
        columns = []
        for what, ends in (("pairs", "pair_ends"), ("same", "same_ends")):
            many, values = found.flat(what, ends)
            known, at = np.unique(values, return_inverse=True)
            total = np.bincount(at, np.repeat(weight, many), len(known)).astype(np.int64)
            columns.append((many, at, known, total))
        (pair_many, pair_at, pairs, pair_times), (same_many, same_at, same, same_times) = columns
        # A chunk that only texts without tokens hold weighs nothing.
        used, used_same = pair_times > 0, same_times > 0
        step = np.diff(code, prepend=0)
        begins = (np.cumsum(chunks) - chunks)[chunks > 0]
        step[begins] = code[begins]
        body = _packed(
            {
                "doc_id": piece.column("doc_id").cast(pa.int64()),
                **{name: pa.array(found.numbers[:, k]) for k, name in enumerate(_NUMBERS)},
                "groups_sha256": pa.array(_sha256(found.groups), pa.string()),
                "chunks": chunks,
                "step": step,
                "times": times,
                "pair_many": pair_many,
                "pair_a": pairs[pair_at] // PAIR,
                "pair_b": pairs[pair_at] % PAIR,
                "same_many": same_many,
                "same_at": same[same_at],
            }
        )
        sums = {"pairs": pairs[used], "pair_times": pair_times[used], "same": same[used_same], "same_times": same_times[used_same]}
        return body, sums

    return df.select("doc_id", F.col(text).alias("text")).mapInArrow(run, _SLICES)


def _summed(slices: DataFrame, keys: str, times: str) -> DataFrame:
    rows = slices.select(F.explode(F.arrays_zip(F.col(keys).alias("key"), F.col(times).alias("n"))).alias("r"))
    return rows.groupBy(F.col("r.key").alias("key")).agg(F.sum("r.n").alias("n"))


def counted(slices: DataFrame, same_id: np.ndarray) -> DataFrame:
    """``key`` (a pair of ids) and its links in the corpus; written, since two reads follow."""
    spark = slices.sparkSession
    found = _summed(slices, "same", "same_times").collect()  # at most one row per A id
    same = spark.createDataFrame([(r["key"] * PAIR + int(same_id[r["key"]]), r["n"]) for r in found], "key long, n long")
    path = scratch_path(spark, "alignment-pairs")
    _summed(slices, "pairs", "pair_times").unionByName(same).groupBy("key").agg(F.sum("n").alias("n")).write.parquet(path)
    return spark.read.parquet(path)


def written_slices(df: DataFrame, text: str, paths: tuple[str, str]) -> DataFrame:
    """The slices as a table whose row groups are small, since writers and readers hold a whole one."""
    path = scratch_path(df.sparkSession, "alignment-slices")
    sizes = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1}
    slices_of(df, text, paths).write.options(compression="zstd", **sizes).parquet(path)
    return df.sparkSession.read.parquet(path)


def pair_counts(df: DataFrame, text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """a_id, b_id, links: how many links of all texts hold a pair of ids."""
    paths = paths or tokenizer_paths()
    found = counted(written_slices(df, text, paths), Aligner(*paths).same_id)
    return found.select(
        F.expr(f"key div {PAIR}").alias("a_id"), (F.col("key") % PAIR).alias("b_id"), F.col("n").alias("links")
    )


_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def digests(df: DataFrame, text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """Numbers of tokens, groups and links of all texts, best links, summed counts, and a digest of the groups.

    ``n_best`` counts links whose count is the highest of their B id.
    """
    spark = df.sparkSession
    paths = paths or tokenizer_paths()
    tool = Aligner(*paths)
    slices = written_slices(df, text, paths)
    counts = counted(slices, tool.same_id)
    # One number per id of a vocabulary, whatever the corpus.
    best = np.zeros(len(tool.b_bytes), np.int64)
    for row in counts.groupBy((F.col("key") % PAIR).alias("b")).agg(F.max("n").alias("n")).collect():
        best[row["b"]] = row["n"]
    same_keys = [(i * PAIR + int(b), i) for i, b in enumerate(tool.same_id) if b >= 0]
    same = np.zeros(len(tool.a_bytes), np.int64)
    wanted = spark.createDataFrame(same_keys, "key long, a long")
    for row in counts.join(F.broadcast(wanted), "key").collect():
        same[row["a"]] = row["n"]
    vectors = spark.sparkContext.broadcast((best, same, tool.same_id))

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        best, same, same_id = vectors.value
        right = right.sort_by("key")
        keys, n = right["key"].to_numpy(), right["n"].to_numpy()
        slice_of = _unpacked(b"".join(left.sort_by("part")["body"].to_pylist()))
        many, step, times, pair_a, pair_b, same_at, pair_many, same_many = (
            slice_of.pop(name).to_numpy().astype(np.int64)
            for name in ("chunks", "step", "times", "pair_a", "pair_b", "same_at", "pair_many", "same_many")
        )
        sums = np.concatenate([[0], np.cumsum(step)])
        begin = np.cumsum(many) - many
        code = sums[1:] - np.repeat(sums[begin], many)
        pair = pair_a * PAIR + pair_b
        at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
        # Pairs that weigh nothing have no row and no text that asks for them.
        count = np.where(keys[at] == pair, n[at], 0) if len(keys) else np.zeros(len(pair), np.int64)
        links = [
            (pair_many, count, count == best[pair_b]),
            (same_many, same[same_at], same[same_at] == best[same_id[same_at]]),
        ]
        total, top = 0, 0
        for each, counts_of, is_best in links:
            ends = np.concatenate([[0], np.cumsum(each)])
            total = total + np.diff(np.concatenate([[0], np.cumsum(counts_of)])[ends])
            top = top + np.diff(np.concatenate([[0], np.cumsum(is_best)])[ends])
        for name, per_chunk in (("n_best", top), ("count_sum", total)):
            ends = np.concatenate([[0], np.cumsum(per_chunk[code] * times)])
            slice_of[name] = pa.array(ends[begin + many] - ends[begin])
        return pa.table({name: slice_of[name] for name in (f.split()[0] for f in _RESULT.split(", "))})

    asked = slices.select(F.col("slice").alias("asking"), F.explode("pairs").alias("key")).join(counts, "key").groupBy("asking")
    given = slices.select("slice", "part", "body").groupBy("slice")
    return given.cogroup(asked).applyInArrow(join, _RESULT)
