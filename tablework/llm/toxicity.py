"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The index holds a bounded, documented sample of labelled documents. Its terms
are words (lower case, without punctuation at the ends) that two examples share
and whose frequency differs between toxic and clean examples by more than chance:
the likelihood ratio of the two counts is at least ``ASSOCIATION``, at every size,
so more examples bring more terms. Cosines are exact over these terms; all other
words have weight zero. Document frequencies are counted over all documents.
Examples lie in blocks; for every term a block stores the weights of its
examples and their maximum. A query sums the maxima to a bound per block, visits
blocks by descending bound and stops when no bound exceeds the k-th best
similarity, so the neighbours are exact (ties: the smaller example number).
Texts of a slice with the same term counts are looked up once.

Neighbours vote with their similarity; a logistic curve fitted on labelled rows
outside the index turns votes into probabilities. The nearest toxic examples are
returned as evidence.

A null or empty text, or one without a term of the index, has no neighbours and
gets the share of toxic rows among such rows of the curve. Equal texts get equal
scores, and repeated rows are scored one by one; a label that occurs twice counts
once (see ``labelled``). Very long texts are read whole. Without labels every
score is 0, and an empty table gives no rows. Input columns are kept; a clash
with a result name is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm import labelled
from tablework.llm import words as W
from tablework.llm.columns import reserve
from tablework.runtime import cut_lineage

#: Toxic labelled rows in the index, about; fewer where there are fewer.
EXAMPLE_ROWS = 1_000
#: Clean rows in the index for each toxic one. Toxic words are rare in clean rows, so it takes
#: many of these to tell them from other rare words.
CLEAN_PER_TOXIC = 4
#: Labelled rows of each label that the probability curve is fitted on, about.
CURVE_ROWS = 1_000
#: Share of the labelled rows kept for the curve, out of 100.
CURVE_SHARE = 20
#: A term of fewer examples can't tie examples together and isn't indexed, at any size.
LEAST_EXAMPLES = 2
#: Least likelihood ratio of a term's two counts: chance alone exceeds it for one word in 16,000.
ASSOCIATION = 16.0
#: Weight of a term: (1 + log count) times idf to this power.
IDF_POWER = 1
#: Bytes of text that a task works on at once.
SLICE_BYTES = 2 << 20
BLOCK, NEIGHBOURS = 32, 15
THRESHOLD = 0.7
EVIDENCE = 3


class Terms:
    """Numbers of the indexed terms, looked up per distinct word."""

    def __init__(self, names: list[str]):
        self.number = {t: i for i, t in enumerate(names)}

    def vectors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets per text into its distinct terms (ascending) and their counts."""
        offsets, codes, tokens = W.word_codes(texts)
        known = np.fromiter(
            (self.number.get(W.bare(t), -1) for t in tokens.to_pandas().tolist()), np.int64, len(tokens)
        )
        found = known[codes] if len(codes) else np.empty(0, np.int64)
        keep = found >= 0
        owner, term, count = W.distinct_per_owner(W.owners(offsets)[keep], found[keep])
        return np.searchsorted(owner, np.arange(len(offsets))), term, count


class BlockIndex:
    """Example vectors in blocks, with the maximum of every term per block."""

    def __init__(self, terms: list[str], idf: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, ids: np.ndarray):
        self.terms, self.idf, self.toxic, self.ids = Terms(terms), idf.astype(np.float32), toxic, ids
        self.offsets = np.cumsum([0, *(len(t) for t, _ in vectors)])
        flat = [np.concatenate([v[i] for v in vectors]) if vectors else np.empty(0) for i in (0, 1)]
        self.flat = [v.astype(np.int32) for v in flat]
        blocks = -(-len(vectors) // BLOCK)
        self.most = np.zeros((len(terms), blocks), np.float32)
        self.rows = np.full((blocks, len(terms)), -1, np.int32)
        self.weights: list[np.ndarray] = []
        for b in range(blocks):
            part = vectors[b * BLOCK : (b + 1) * BLOCK]
            here = np.unique(np.concatenate([t for t, _ in part])) if part else np.empty(0, int)
            dense = np.zeros((len(here), len(part)), np.float32)
            for column, (term, count) in enumerate(part):
                dense[np.searchsorted(here, term), column] = self.weigh(term, count)
            self.rows[b, here] = np.arange(len(here))
            self.weights.append(dense)
            if len(here):
                self.most[here, b] = dense.max(1)

    def __reduce__(self):
        # Sparse on the way: the blocks are many times larger and are built again in each worker.
        return _rebuilt, (list(self.terms.number), self.idf, self.offsets, self.flat, self.toxic, self.ids)

    def weigh(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        w = (1 + np.log(count)).astype(np.float32) * self.idf[term]
        norm = np.sqrt((w.astype(np.float64) ** 2).sum())
        return w / np.float32(norm) if norm else w

    def nearest(self, term: np.ndarray, count: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and similarities of the k nearest examples, best first."""
        if not len(term) or not self.weights:
            return np.empty(0, np.int64), np.empty(0, np.float32)
        q = self.weigh(term, count)
        # A little above the sum, so that rounding never hides a block.
        bound = q @ self.most[term] * np.float32(1.00001) + np.float32(1e-6)
        held, sims = np.empty(0, np.int64), np.empty(0, np.float32)
        least = np.float32(0)
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= least:
                break
            at = self.rows[b, term]
            inside = at >= 0
            s = q[inside] @ self.weights[b][at[inside]]
            better = np.flatnonzero(s >= least) if len(held) >= k else np.flatnonzero(s > 0)
            if not len(better):
                continue
            held = np.append(held, b * BLOCK + better)
            sims = np.append(sims, s[better])
            if len(held) > k:
                order = np.lexsort((held, -sims))[:k]
                held, sims = held[order], sims[order]
            if len(held) >= k:
                least = sims.min()
        order = np.lexsort((held, -sims))
        return held[order], sims[order]

    def vote(self, near: np.ndarray, sims: np.ndarray) -> float:
        """Similarity-weighted share of toxic neighbours."""
        return float(sims @ self.toxic[near] / sims.sum()) if len(near) else -1.0


def _rebuilt(terms: list[str], idf: np.ndarray, offsets: np.ndarray, flat: list[np.ndarray], toxic: np.ndarray, ids: np.ndarray) -> BlockIndex:
    term, count = (np.split(v, offsets[1:-1]) for v in flat)
    return BlockIndex(terms, idf, list(zip(term, count, strict=True))[: len(offsets) - 1], toxic, ids)


def _documents(docs: DataFrame, text: str) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))


def _distinct_words(rows: DataFrame) -> DataFrame:
    """One row per document and distinct word, with the document's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.slices(batches, "text", SLICE_BYTES):
            offsets, codes, tokens = W.word_codes(piece.column("text"))
            plain = pd.Series([W.bare(t) for t in tokens.to_pandas().tolist()], dtype=object)
            number, names = pd.factorize(plain)
            owner, word, _ = W.distinct_per_owner(W.owners(offsets), number[codes])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(names)[word], pa.string()), piece.column("label").take(pa.array(owner))],
                names=["word", "label"],
            )

    return rows.select("text", "label").mapInArrow(run, "word string, label int").where("word <> ''")


def likelihood_ratio(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """Twice the log likelihood ratio of a word's share among toxic and among clean examples."""
    share = (toxic + clean) / (n_toxic + n_clean)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)

    return 2 * (
        part(toxic, n_toxic * share)
        + part(clean, n_clean * share)
        + part(n_toxic - toxic, n_toxic * (1 - share))
        + part(n_clean - clean, n_clean * (1 - share))
    )


def index_terms(examples: DataFrame) -> list[str]:
    """The words of labelled examples that the index holds; at most as many as their words."""
    counts = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = _distinct_words(examples).groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    )
    ratio = likelihood_ratio(F.col("toxic"), F.col("clean"), counts.get(1, 0), counts.get(0, 0))
    kept = words.where((F.col("toxic") + F.col("clean") >= LEAST_EXAMPLES) & (ratio >= ASSOCIATION))
    return sorted(r["word"] for r in kept.select("word").collect())


def corpus_counts(docs: DataFrame, terms: list[str], text: str = "text") -> tuple[np.ndarray, int]:
    """Document frequency of every term over all documents, and their number."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(shared.value)
        counts, rows = np.zeros(len(shared.value) + 1, np.int64), 0
        for piece in W.slices(batches, "text", SLICE_BYTES):
            _, term, _ = known.vectors(piece.column("text"))
            counts[:-1] += np.bincount(term, minlength=len(counts) - 1)
            rows += piece.num_rows
        counts[-1] = rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["term", "n"])

    parts = _documents(docs, text).mapInArrow(run, "term long, n long")
    total = np.zeros(len(terms) + 1, np.int64)
    for row in parts.groupBy("term").agg(F.sum("n").alias("n")).collect():
        total[row["term"]] = row["n"]
    return total[:-1], int(total[-1])


def build_index(docs: DataFrame, labels: DataFrame, text: str = "text", rows: int = EXAMPLE_ROWS) -> BlockIndex | None:
    """The index over about ``rows`` toxic examples and the clean ones beside them; None without any example.

    Collected are the terms (bounded by the sample) and one sparse vector over
    them per example.
    """
    clean = labels.where("label = 0")
    chosen = labelled.sample(labels.where("label = 1"), rows, salt=3).unionByName(
        labelled.sample(clean, rows * CLEAN_PER_TOXIC, salt=3)
    )
    examples = cut_lineage(_documents(docs, text).join(F.broadcast(chosen), "doc_id"))
    if not examples.limit(1).count():
        return None
    terms = index_terms(examples)
    counts, total = corpus_counts(docs, terms, text)
    idf = np.log(1 + total / np.maximum(counts, 1)) ** IDF_POWER
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(shared.value)
        for piece in W.slices(batches, "text", SLICE_BYTES):
            offsets, term, count = known.vectors(piece.column("text"))
            cut = pa.array(offsets.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("label"),
                    pa.ListArray.from_arrays(cut, pa.array(term)),
                    pa.ListArray.from_arrays(cut, pa.array(count)),
                ],
                names=["doc_id", "label", "terms", "counts"],
            )

    vectors = examples.mapInArrow(run, "doc_id long, label int, terms array<long>, counts array<long>").collect()
    # Examples of one label and with similar rarest terms share blocks, which keeps the maxima low.
    vectors.sort(key=lambda r: (r["label"], max(r["terms"], key=lambda t: (idf[t], t), default=-1), r["doc_id"], r["terms"], r["counts"]))
    return BlockIndex(
        terms,
        idf,
        [(np.array(r["terms"], np.int64), np.array(r["counts"], np.int64)) for r in vectors],
        np.array([r["label"] for r in vectors], np.float32),
        np.array([r["doc_id"] for r in vectors], np.int64),
    )


def votes(docs: DataFrame, index: BlockIndex, text: str = "text", k: int = NEIGHBOURS) -> DataFrame:
    """``docs`` with ``vote`` (-1 without a neighbour) and ``evidence``, ids of the nearest toxic examples."""
    reserve(docs, ["vote", "evidence"])
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("vote", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.LongType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for piece in W.slices(batches, text, SLICE_BYTES):
            offsets, term, count = held.terms.vectors(W.texts_of(piece, text))
            vote, evidence = [], []
            known: dict[bytes, tuple[float, list[int]]] = {}
            for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                key = term[s:e].tobytes() + count[s:e].tobytes()
                if key not in known:
                    near, sims = held.nearest(term[s:e], count[s:e], k)
                    known[key] = round(held.vote(near, sims), 5), held.ids[near[held.toxic[near] > 0][:EVIDENCE]].tolist()
                vote.append(known[key][0])
                evidence.append(known[key][1])
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(vote, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))],
                names=[*piece.schema.names, "vote", "evidence"],
            )

    return docs.mapInArrow(run, schema)


def fit_curve(points: list[tuple[float, int]], weights: dict[int, float]) -> tuple[float, float]:
    """Slope and place of the logistic curve of label against vote, by Newton's method.

    ``weights`` bring the sampled labels back to their shares; a small penalty
    keeps the curve finite when the votes separate the labels.
    """
    x = np.array([[v, 1.0] for v, _ in points])
    y = np.array([label for _, label in points], float)
    w = np.array([weights[label] for _, label in points])
    ab = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        gradient = x.T @ (w * (p - y)) + 0.05 * ab
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        ab = ab - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(ab[0]), float(ab[1])


def classify(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    held_out: int = 1,
    folds: int = 3,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with score, predicted and evidence, from ``labels.toxic`` outside the held-out fold."""
    reserve(docs, ["score", "predicted", "evidence"])
    known = cut_lineage(labelled.training_labels(labels, "toxic", held_out, folds))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    aside = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(100)) < CURVE_SHARE
    rows = min(EXAMPLE_ROWS, counts.get(1, 0)) or EXAMPLE_ROWS
    index = build_index(docs, known.where(~aside), text, rows) if counts else None
    if index is None:
        return docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.array().cast("array<long>").alias("evidence"))
    prior = counts.get(1, 0) / sum(counts.values())
    rest = labelled.sample(known.where(aside), CURVE_ROWS, salt=4)
    voted = votes(_documents(docs, text).join(F.broadcast(rest), "doc_id"), index).select("vote", "label").collect()
    seen = {label: max(1, sum(1 for r in voted if r["label"] == label)) for label in (0, 1)}
    # What a sampled row of either label stands for among all rows.
    share = {0: (1 - prior) * len(voted) / seen[0], 1: prior * len(voted) / seen[1]}
    points = [(r["vote"], r["label"]) for r in voted if r["vote"] >= 0]
    slope, place = fit_curve(sorted(points), share) if points else (1.0, 0.0)
    lone = [share[r["label"]] * np.array([r["label"], 1]) for r in voted if r["vote"] < 0]
    toxic_lone, all_lone = np.sum([*lone, np.array([prior, 1.0])], axis=0)
    without = float(toxic_lone / all_lone)
    curve = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("vote") * slope + place)))
    scored = F.round(F.when(F.col("vote") < 0, without).otherwise(curve), 6)
    return (
        votes(docs, index, text)
        .withColumn("score", scored)
        .select(*docs.columns, "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")
    )
