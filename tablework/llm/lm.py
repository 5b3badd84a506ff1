"""Language-model scores by stupid backoff, from counts of the corpus itself.

Words are lowered (A-Z). Every word keeps its name and its count; only a caller
who gives ``vocabulary`` merges the words after the most frequent ones into one
unknown word. Texts begin and end at one boundary symbol, so a text of m words
has m + 1 transitions.

For a transition from h to w with c(hw) >= ``LEAST_COUNT`` the score is
c(hw)/c(h), else ``BACKOFF`` * c(w)/N. Logarithms are kept as whole millionths, so
sums don't depend on their order.

Exploded bigrams (document, bigram, number) are partitioned by the hash of the
bigram, packed per map slice; each hash partition builds its part of the bigram
count table and joins it to its exploded bigrams; the partial sums are summed
per document. The counts of the ``HEAD`` most frequent words are broadcast. All
others (rare words) have a 64-bit code, checked to be unlike for unlike words,
and their counts are partitioned by its hash. A bigram with a rare word goes to
the partition of that word; one of two rare words goes to both, the first one
scoring it where it was seen, the second one where it backs off.

A null or empty text has one transition, from boundary to boundary. Rows sharing
an id are scored as one document; a null id is one document of its own. Very long
texts are counted and scored whole. An empty table gives an empty result. Other
columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm import words as W
from tablework.runtime import scratch_path

#: Words that keep their name; None is all.
VOCABULARY = None
#: Words whose counts are broadcast.
HEAD = 65_534
LEAST_COUNT = 2
BACKOFF = 0.4
#: Bigram rows in a hash partition, about, and the most partitions of one map slice.
PART_ROWS, MOST_PARTS = 2_000_000, 20_000
#: Documents whose partial sums meet in one group, about.
GROUP_DOCS = 8_000
#: Stands for a null id inside the packed rows.
NULL_ID = -(1 << 63)

BOUNDARY, UNKNOWN = 0, 1
_U = np.uint64
#: Set in every code of a rare word, and in the other word of a bigram that lies at its second word.
RARE, BACK = _U(1 << 63), _U(1 << 62)
#: Bits of a code that tell words apart.
CODE_BITS = 62
#: What the rows of a hash partition hold.
FREQUENT_PAIRS, RARE_PAIRS, RARE_COUNTS = 0, 1, 2
_ROWS = "part long, kind int, keys binary, others binary, pointers binary, counts binary, docs binary"


def micro_log(x: np.ndarray) -> np.ndarray:
    """Natural logarithms in whole millionths."""
    return np.floor(np.log(np.maximum(x, 1)) * 1e6 + 0.5).astype(np.int64)


def codes_of(words: list[str], salt: int, bits: int = CODE_BITS) -> np.ndarray:
    """Codes of rare words."""
    if not words:
        return np.empty(0, _U)
    hashed = pd.util.hash_array(np.array(words, dtype=object), hash_key=f"{salt:016d}", categorize=False)
    return (hashed >> _U(64 - bits)) | RARE


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (W.scramble(keys * W.MIX) >> _U(32)).astype(np.int64) % parts


class Unigrams:
    """Counts of the frequent words by number (0 is the boundary, 1 the unknown word), and how rare ones are coded."""

    def __init__(self, words: list[str], counts: list[int], total: int, texts: int, salt: int | None):
        self.number = {w: i + 2 for i, w in enumerate(words)}
        self.counts = np.array([texts, total - sum(counts), *counts], np.int64)
        self.all = total + texts
        #: None where all other words are the unknown word.
        self.salt = salt

    def numbered(self, words: list[str]) -> np.ndarray:
        """The number of each frequent word, the code of each rare one."""
        found = np.fromiter((self.number.get(w, UNKNOWN) for w in words), _U, len(words))
        if self.salt is not None:
            rare = np.flatnonzero(found == UNKNOWN)
            found[rare] = codes_of([words[i] for i in rare.tolist()], self.salt)
        return found


def free_salt(words: DataFrame, bits: int = CODE_BITS) -> int:
    """The first salt under which no two ``words`` share a code."""
    salt = 0
    while True:

        def run(batches: Iterator[pa.RecordBatch], salt: int = salt) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = codes_of(batch.column("word").to_pylist(), salt, bits)
                yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64))], names=["code"])

        codes = words.select("word").mapInArrow(run, "code long")
        if not codes.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
            return salt
        salt += 1


def unigrams(docs: DataFrame, text: str = "text", vocabulary: int | None = VOCABULARY) -> tuple[Unigrams, DataFrame | None]:
    """Word counts over all documents, and the table of rare words and their counts (None without).

    Only the frequent words and two totals reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = 0
        for piece in W.gathered(batches):
            _, codes, tokens = W.word_codes(W.texts_of(piece))
            lowered = pd.Series(np.bincount(codes, minlength=len(tokens))).groupby(
                [W.lower_ascii(t) for t in tokens.to_pandas().tolist()]
            ).sum()
            texts += piece.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(lowered.index.tolist(), pa.string()), pa.array(lowered.to_numpy().astype(np.int64))], names=["word", "n"]
            )
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([texts])], names=["word", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    path = scratch_path(docs.sparkSession, "words")
    counted.groupBy("word").agg(F.sum("n").alias("n")).write.parquet(path)
    table = docs.sparkSession.read.schema("word string, n long").parquet(path)
    totals = table.agg(
        F.sum(F.when(F.col("word").isNotNull(), F.col("n"))).alias("words"),
        F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("texts"),
    ).first()
    # The count from which all words fit tells what to collect; of its ties the first by name fill up.
    words = table.where("word IS NOT NULL")
    sizes = sorted(((r["n"], r["words"]) for r in words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    left, cut = vocabulary or HEAD, 0
    for n, many in sizes:
        if many > left:
            cut = n
            break
        left -= many
    top = words.where(F.col("n") > cut).collect()
    if cut:
        top += words.where(F.col("n") == cut).orderBy("word").limit(left).collect()
    top.sort(key=lambda r: (-r["n"], r["word"]))
    rare = None
    if cut and vocabulary is None:
        # Of the ties at the cut the first by name are frequent.
        last = max((r["word"] for r in top if r["n"] == cut), default=None)
        tied = F.lit(True) if last is None else F.col("word") > last
        rare = words.where((F.col("n") < cut) | ((F.col("n") == cut) & tied))
    salt = None if rare is None else free_salt(rare)
    names, counts = [r["word"] for r in top], [r["n"] for r in top]
    return Unigrams(names, counts, totals["words"] or 0, totals["texts"] or 0, salt), rare


def _pack(part: np.ndarray, parts: int, columns: list[np.ndarray]) -> list[list[bytes]]:
    """The bytes of every column per part; ``part`` is sorted."""
    cuts = np.searchsorted(part, np.arange(parts + 1))
    return [[c[s:e].tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True) if e > s] for c in columns]


def exploded(docs: DataFrame, table: Unigrams, parts: int, text: str = "text") -> DataFrame:
    """Distinct bigrams of every document with their numbers, packed per slice and hash partition."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.gathered(batches):
            offsets, codes, tokens = W.word_codes(W.texts_of(piece))
            named = shared.value.numbered([W.lower_ascii(t) for t in tokens.to_pandas().tolist()])
            ids = pa.compute.fill_null(piece.column("doc_id"), NULL_ID).to_numpy(zero_copy_only=False)
            many = np.diff(offsets)
            # Every text as boundary, words, boundary.
            at = np.arange(len(codes)) + 2 * W.owners(offsets) + 1
            line = np.full(len(codes) + 2 * len(many), BOUNDARY, _U)
            line[at] = named[codes] if len(codes) else 0
            ends = np.cumsum(many + 2)
            inside = np.ones(len(line) - 1, bool)
            inside[ends[:-1] - 1] = False
            first, second = line[:-1][inside], line[1:][inside]
            owner = np.repeat(np.arange(len(many)), many + 1)
            early, late = first >= RARE, second >= RARE
            plain = ~(early | late)
            key = first[plain] << _U(16) | second[plain]
            yield from packed(FREQUENT_PAIRS, owner[plain], key, np.zeros(len(key), _U), ids)
            own = np.concatenate([first[early], second[late]])
            other = np.concatenate([second[early], first[late] | BACK])
            if len(own):
                yield from packed(RARE_PAIRS, np.concatenate([owner[early], owner[late]]), own, other, ids)

    def packed(kind: int, owner: np.ndarray, key: np.ndarray, other: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = part_of(key, parts)
        order = np.lexsort((owner, other, key, part))
        part, key, other, owner = part[order], key[order], other[order], owner[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (other[1:] != other[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(key)))
        part, key, other, owner = part[at], key[at], other[at], owner[at]
        # A document is named once per part; rows point to its name.
        names, pointer = np.unique(part * len(ids) + owner, return_inverse=True)
        start = np.searchsorted(names, part * len(ids))
        doc_part, doc = names // max(len(ids), 1), ids[names % max(len(ids), 1)]
        present = np.unique(part)
        wide = kind == RARE_PAIRS
        keys, others, pointers, counts = _pack(
            part,
            parts,
            [key.astype("<u8" if wide else "<u4"), other.astype("<u8"), (pointer - start).astype("<u4"), np.minimum(count, 2**31).astype("<u4")],
        )
        (docs_of,) = _pack(doc_part, parts, [doc.astype("<i8")])
        others = others if wide else [b""] * len(present)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(present),
                pa.array([kind] * len(present), pa.int32()),
                *[pa.array(v, pa.binary()) for v in (keys, others, pointers, counts, docs_of)],
            ],
            names=["part", "kind", "keys", "others", "pointers", "counts", "docs"],
        )

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, _ROWS)


def rare_counts(rare: DataFrame, salt: int, parts: int) -> DataFrame:
    """Codes and counts of the rare words, packed by hash partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = codes_of(batch.column("word").to_pylist(), salt)
            part = part_of(codes, parts)
            order = np.argsort(part, kind="stable")
            n = batch.column("n").to_numpy(zero_copy_only=False)
            keys, counts = _pack(part[order], parts, [codes[order].astype("<u8"), n[order].astype("<i8")])
            present, none = np.unique(part), [b""] * len(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(present),
                    pa.array([RARE_COUNTS] * len(present), pa.int32()),
                    *[pa.array(v, pa.binary()) for v in (keys, none, none, counts, none)],
                ],
                names=["part", "kind", "keys", "others", "pointers", "counts", "docs"],
            )

    return rare.select("word", "n").mapInArrow(run, _ROWS)


def _arrays(frame: pd.DataFrame, name: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(v, kind) for v in frame[name]]


def _documents_of(frame: pd.DataFrame) -> list[np.ndarray]:
    return [d[p] for d, p in zip(_arrays(frame, "docs", "<i8"), _arrays(frame, "pointers", "<u4"), strict=True)]


def _rare_logs(
    wide: pd.DataFrame, table: pd.DataFrame, count: np.ndarray, single: np.ndarray, back_off: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log, whether it was seen and whether it counts as a transition, for every row with a rare word."""
    own, other = (np.concatenate(_arrays(wide, c, "<u8")) for c in ("keys", "others"))
    codes, n = np.concatenate(_arrays(table, "keys", "<u8")), np.concatenate(_arrays(table, "counts", "<i8"))
    by_code = np.argsort(codes)
    own_n = n[by_code][np.searchsorted(codes[by_code], own)]
    order = np.lexsort((other, own))
    new = np.ones(len(own), bool)
    new[1:] = (np.diff(own[order]) != 0) | (np.diff(other[order]) != 0)
    at = np.empty(len(own), np.int64)
    at[order] = np.cumsum(new) - 1
    seen = (np.bincount(at, count) >= LEAST_COUNT)[at]
    times = micro_log(np.bincount(at, count))[at]
    back, other = (other & BACK) != 0, other & ~BACK
    both = other >= RARE
    other_log = micro_log(single[np.where(both, 0, other).astype(np.int64)])
    own_log = micro_log(own_n)
    first, second = np.where(back, other_log, own_log), np.where(back, own_log, other_log)
    logs = np.where(seen, times - first, second + back_off)
    # Of two rare words the first one's part knows c(h), the second one's c(w).
    return np.where(both & (back == seen), 0, logs), seen, ~(both & back)


def joined(rows: DataFrame, table: Unigrams, sums: int) -> DataFrame:
    """Partial sums of every hash partition, packed by document."""
    shared = rows.sparkSession.sparkContext.broadcast((table.counts, table.all))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        single, total = shared.value
        back_off = _BACKOFF_LOG - micro_log(np.array(total))
        pairs, wide, table = (frame[frame["kind"] == kind] for kind in (FREQUENT_PAIRS, RARE_PAIRS, RARE_COUNTS))
        doc = np.concatenate([np.empty(0, "<i8"), *_documents_of(pairs), *_documents_of(wide)])
        count = np.concatenate([np.empty(0, "<u4"), *_arrays(pairs, "counts", "<u4"), *_arrays(wide, "counts", "<u4")]).astype(np.int64)
        key = np.concatenate([np.empty(0, "<u4"), *_arrays(pairs, "keys", "<u4")])
        # This part of the count table, and its join to the exploded bigrams.
        bigrams, at = np.unique(key, return_inverse=True)
        times = np.bincount(at, count[: len(key)], len(bigrams)).astype(np.int64)
        before, after = single[bigrams >> 16], single[bigrams & 0xFFFF]
        hit = times >= LEAST_COUNT
        logs = np.where(hit, micro_log(times) - micro_log(before), micro_log(after) + back_off)[at]
        seen, moved = hit[at], np.ones(len(key), bool)
        if len(wide):
            more = _rare_logs(wide, table, count[len(key) :], single, back_off)
            logs, seen, moved = (np.concatenate(v) for v in zip((logs, seen, moved), more, strict=True))
        names, at_doc = np.unique(doc, return_inverse=True)
        score = np.zeros(len(names), np.int64)
        np.add.at(score, at_doc, logs * count)
        moves = np.bincount(at_doc, count * moved, len(names)).astype(np.int64)
        hits = np.bincount(at_doc, count * (seen & moved), len(names)).astype(np.int64)
        to = (W.scramble(names.view(_U) * W.MIX) >> _U(32)).astype(np.int64) % sums
        order = np.argsort(to, kind="stable")
        kinds = {"<i8": (names, score), "<u4": (moves, hits)}
        packed = _pack(to[order], sums, [v[order].astype(kind) for kind, group in kinds.items() for v in group])
        return pd.DataFrame(dict(zip(("to", "docs", "score", "moves", "hits"), [np.unique(to), *packed], strict=True)))

    return rows.groupBy("part").applyInPandas(run, "to long, docs binary, score binary, moves binary, hits binary")


def summed(partial: DataFrame) -> DataFrame:
    """doc_id, n_words, log_score, mean_log_score and the share of transitions that were seen."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        doc = np.concatenate(_arrays(frame, "docs", "<i8"))
        names, at = np.unique(doc, return_inverse=True)
        total = {c: np.zeros(len(names), np.int64) for c in ("score", "moves", "hits")}
        for c, held in total.items():
            np.add.at(held, at, np.concatenate(_arrays(frame, c, "<i8" if c == "score" else "<u4")).astype(np.int64))
        return pd.DataFrame({"doc_id": names, **total})

    whole = partial.groupBy("to").applyInPandas(run, "doc_id long, score long, moves long, hits long")
    log = F.col("score") / F.lit(1e6)
    return whole.select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"),
        F.col("moves").alias("n_transitions"),
        F.col("hits").alias("n_seen"),
        log.alias("log_score"),
        (log / F.col("moves")).alias("mean_log_score"),
    )


_BACKOFF_LOG = int(np.floor(np.log(BACKOFF) * 1e6 + 0.5))


def score(docs: DataFrame, text: str = "text", vocabulary: int | None = VOCABULARY, part_rows: int = PART_ROWS) -> DataFrame:
    """Stupid-backoff scores of all documents under the counts of all documents."""
    if vocabulary is not None and not 0 < vocabulary <= HEAD:
        raise ValueError(f"a closed vocabulary holds 1 to {HEAD} words")
    table, rare = unigrams(docs, text, vocabulary)
    parts = min(MOST_PARTS, max(8, -(-table.all // part_rows)))
    sums = max(4, -(-int(table.counts[BOUNDARY]) // GROUP_DOCS))
    rows = exploded(docs, table, parts, text)
    if rare is not None:
        rows = rows.unionByName(rare_counts(rare, table.salt, parts))
    return summed(joined(rows, table, sums))
