"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL.

Words are runs of letters and digits or runs of other signs; a word that repeats
its predecessor becomes one fixed word. Features are hashed single words and
pairs, a text's vector is its feature counts over the square root of their
number, and a score is the logistic of a sparse dot product.

Training reads a bounded, documented sample of labelled rows. It is split into
shards by id; each shard runs follow-the-regularised-leader updates over its
rows in id order, and the shards' weights are averaged.

A null or empty text has no features and gets the score of the bias. Equal texts
get equal scores, and repeated rows are scored one by one; a label that occurs
twice counts once (see ``labelled``), but each row of its id is an example. Very
long texts are read whole. Without any label every score is 0.5, and an empty
table gives no rows. Columns of the input are kept; a clash with ``score`` or
``predicted`` is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm import labelled
from tablework.llm import words as W
from tablework.llm.columns import reserve

#: Size of the hashed feature space; the model is that many 32-bit weights and a bias.
DIMENSIONS = 1 << 18
#: Labelled rows of each label that training reads, about.
SAMPLE_ROWS = 8_000
SHARDS = 8
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 1.0
#: Scores from here on are predicted as good.
THRESHOLD = 0.7

_WORDS = regex.compile(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\n]+|\n")


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets per text and its hashed features, one per occurrence."""
    offsets, codes, tokens = W.word_codes(texts)
    # Each distinct token once more into words.
    parts = _WORDS.findall("\n".join([*tokens.to_pandas().tolist(), ""]).lower())
    numbers, names = pd.factorize(np.array(parts, dtype=object))
    line_end = names[numbers] == "\n"
    line = np.cumsum(line_end) - line_end
    starts = np.searchsorted(line[~line_end], np.arange(len(tokens)))
    ends = np.searchsorted(line[~line_end], np.arange(len(tokens)), "right")
    hashed = W.hashes(names)[numbers[~line_end]]
    lengths = (ends - starts)[codes]
    seq = hashed[W.spread(starts[codes], lengths)]
    bounds = np.concatenate([[0], np.cumsum(lengths)])[offsets]
    owner = W.owners(bounds)
    again = np.zeros(len(seq), bool)
    again[1:] = (seq[1:] == seq[:-1]) & (owner[1:] == owner[:-1])
    seq[again] = W.MIX
    pair = np.zeros(len(seq), np.uint64)
    pair[1:] = W.scramble(seq[:-1] * W.MIX + seq[1:])
    inside = np.zeros(len(seq), bool)
    inside[1:] = owner[1:] == owner[:-1]
    shift = np.uint64(64 - DIMENSIONS.bit_length() + 1)
    both = np.stack([(W.scramble(seq) >> shift), (pair >> shift)], 1).astype(np.int32).ravel()
    keep = np.stack([np.ones(len(seq), bool), inside], 1).ravel()
    ends_of = np.concatenate([[0], np.cumsum(keep)])[2 * bounds]
    return ends_of, both[keep]


def ftrl(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int) -> np.ndarray:
    """Weights after FTRL-proximal updates, one example after the other; the bias comes last."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    for _ in range(epochs):
        for (at, value), label in zip(vectors, labels, strict=True):
            zi, ni = z[at], n[at]
            w = np.where(
                np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
            )
            p = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
            g = (p - label) * value
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Averaged weights of the shards, from about ``rows`` documents of each label.

    ``labels`` has doc_id and label. The sample is small enough to be broadcast
    by its bound; only weights come back to the driver.
    """
    chosen = labelled.sample(labels, rows, salt=2)
    known = (
        docs.select(F.col("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)))
    )

    def fit(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["doc_id", "text"]).sample(frac=1, random_state=0)
        vectors = []
        for at in range(0, len(shard), 500):
            offsets, found = features(pa.array(shard["text"].iloc[at : at + 500], pa.string()))
            for s, e in zip(offsets[:-1], offsets[1:], strict=True):
                index, count = np.unique(found[s:e], return_counts=True)
                value = count / np.sqrt(max(1, e - s))
                vectors.append((np.append(index, DIMENSIONS), np.append(value, 1.0)))
        weights = ftrl(vectors, shard["label"].to_numpy(), EPOCHS)
        return pd.DataFrame({"rows": [len(shard)], "weights": [weights.astype("<f4").tobytes()]})

    shards = known.groupBy("shard").applyInPandas(fit, "rows long, weights binary").collect()
    if not shards:
        return np.zeros(DIMENSIONS + 1, np.float32)
    total = sum(r["rows"] for r in shards)
    shards = sorted(shards, key=lambda r: r["weights"])
    return sum(np.frombuffer(r["weights"], "<f4") * (r["rows"] / total) for r in shards).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted."""
    reserve(docs, ["score", "predicted"])
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for piece in W.slices(batches, text):
            offsets, found = features(W.texts_of(piece, text))
            sums = np.concatenate([[0.0], np.cumsum(weight[found], dtype=np.float64)])
            many = np.diff(offsets)
            # Cumulative sums differ in the last digits with what stands before; rounding removes that.
            dot = np.round((sums[offsets[1:]] - sums[offsets[:-1]]) / np.sqrt(np.maximum(many, 1)), 6)
            value = np.round(1 / (1 + np.exp(-np.clip(dot + weight[-1], -30, 30))), 6)
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                names=[*piece.schema.names, "score", "predicted"],
            )

    return docs.mapInArrow(run, schema)


def classify(
    docs: DataFrame, labels: DataFrame, text: str = "text", held_out: int = 2, folds: int = 4, threshold: float = THRESHOLD
) -> DataFrame:
    """Train on ``labels.quality`` outside the held-out fold and score all ``docs``."""
    known = labelled.training_labels(labels, "quality", held_out, folds)
    return score(docs, train(docs, known, text), text, threshold)
