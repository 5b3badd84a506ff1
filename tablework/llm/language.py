"""Language identification with a bidirectional gated recurrent network over bytes.

The network (see ``gru``) gives every byte of a text label probabilities; those
of the bytes that can belong to letters are averaged to the probabilities of the
document, whose greatest is the score. Whole texts are read, in stretches from a
zero state; equal texts of a slice are read once.

Training reads a bounded, documented sample: about ``SAMPLE_ROWS`` labelled rows
of each language, and of each text up to ``SAMPLE_STRETCHES`` stretches spread
evenly over it. Rows are dealt to ``SHARDS`` by id; in each of ``ROUNDS`` every
shard trains by backpropagation through time from the same weights and the
results are averaged. Languages are the distinct labels (at most
``MOST_LANGUAGES``, else an error, since the network has an output for each).

A null text, an empty one and one without a letter are ``und`` with score 0, and
so is every text when no label is known. Very long texts are read whole. Of
equal probabilities the first language by name counts. Equal texts get equal
results, repeated rows are scored one by one, an empty table gives no rows.
Columns of the input are kept; a clash with ``lang_pred`` or ``score`` is an
error raised before any work starts.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm import gru, labelled
from tablework.llm import words as W
from tablework.llm.columns import reserve
from tablework.runtime import scratch_path

#: Labelled rows of each language that training reads, about, and stretches of each text at most.
SAMPLE_ROWS, SAMPLE_STRETCHES = 800, 6
SHARDS, ROUNDS, EPOCHS = 4, 4, 2
RATES = (0.02, 0.015, 0.008, 0.003)
#: Languages that one network tells apart at most.
MOST_LANGUAGES = 1_000
#: Stretches that take each step together.
TOGETHER = 8 * gru.ROWS
UNKNOWN = "und"

#: The names of the outputs and the weights; no names without any label.
Model = tuple[list[str], dict[str, np.ndarray]]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each begins."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    joined = b"".join(texts.cast(pa.binary()).to_pylist())
    return np.frombuffer(joined, np.uint8), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def training_rows(docs: DataFrame, text: str, lang: str, rows: int) -> DataFrame:
    """shard, doc_id, label and the chosen stretches of a sample of labelled rows, written to the shared folder."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        "doc_id", F.col(lang).alias("label"), F.col(text).alias("text")
    )
    chosen = labelled.sample(known, rows, salt=11)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.slices(batches):
            data, offsets = _bytes_of(W.texts_of(piece))
            owner, start, length = gru.stretches(data, offsets)
            many = np.bincount(owner, minlength=piece.num_rows)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
            # The first stretch of each of up to so many equal parts of the text.
            part = nth * SAMPLE_STRETCHES // np.maximum(many[owner], 1)
            before = (nth - 1) * SAMPLE_STRETCHES // np.maximum(many[owner], 1)
            keep = (nth == 0) | (part != before)
            owner, start, length = owner[keep], start[keep], length[keep]
            raw = [data[s : s + n].tobytes() for s, n in zip(start.tolist(), length.tolist(), strict=True)]
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(at), piece.column("label").take(at), pa.array(raw, pa.binary())],
                names=["doc_id", "label", "stretch"],
            )

    schema = T.StructType(
        [chosen.schema["doc_id"], T.StructField("label", T.StringType()), T.StructField("stretch", T.BinaryType())]
    )
    path = scratch_path(docs.sparkSession, "language-sample")
    found = chosen.mapInArrow(run, schema).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)))
    found.write.parquet(path)
    # A task per shard, whatever their size.
    return docs.sparkSession.read.parquet(path).repartition(SHARDS, "shard")


def _shard_trainer(names: list[str], shared: Broadcast, turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    number = {name: i for i, name in enumerate(names)}

    def fit(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["doc_id", "label", "stretch"])
        lengths = shard["stretch"].map(len).to_numpy()
        data = np.frombuffer(b"".join(shard["stretch"]), np.uint8)
        codes, valid = gru.gathered(data, np.cumsum(lengths) - lengths, lengths)
        labels = shard["label"].map(number).to_numpy()
        after = gru.fit(shared.value, codes, valid, labels, EPOCHS, RATES[turn], seed=turn)
        return pd.DataFrame({"rows": [len(shard)], "weights": [pickle.dumps(after)]})

    return fit


def train(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS) -> Model:
    """A network for the languages in ``docs``, which has doc_id, text and lang.

    Only weights come back to the driver.
    """
    sample = training_rows(docs, text, lang, rows)
    names = sorted(r["label"] for r in sample.select("label").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not names:
        return [], {}
    weights = gru.fresh(len(names), seed=11)
    for turn in range(ROUNDS):
        step = _shard_trainer(names, sample.sparkSession.sparkContext.broadcast(weights), turn)
        found = sample.groupBy("shard").applyInPandas(step, "rows long, weights binary").collect()
        found = sorted(found, key=lambda r: r["weights"])
        total = sum(r["rows"] for r in found)
        parts = [(r["rows"] / total, pickle.loads(r["weights"])) for r in found]
        weights = {k: sum(share * part[k] for share, part in parts).astype(np.float32) for k in weights}
    return names, weights


def label_shares(weights: dict[str, np.ndarray], texts: pa.Array) -> np.ndarray:
    """Per text the mean label probabilities of its letter positions; zeros without any."""
    data, offsets = _bytes_of(texts)
    owner, start, length = gru.stretches(data, offsets)
    # Whole stretches first, so that most blocks need no mask.
    order = np.argsort(-length, kind="stable")
    sums = np.zeros((len(texts), len(weights["bias"])))
    many = np.zeros(len(texts), np.int64)
    for at in range(0, len(order), TOGETHER):
        some = order[at : at + TOGETHER]
        full = np.append(some, np.full(-len(some) % gru.ROWS, some[0]))
        codes, valid = gru.gathered(data, start[full], length[full])
        found = gru.label_sums(weights, codes, valid)[: len(some)]
        np.add.at(sums, owner[some], found)
        np.add.at(many, owner[some], (gru.letters(codes) & valid)[:, : len(some)].sum(axis=0))
    return sums / np.maximum(many, 1)[:, None]


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    reserve(docs, ["lang_pred", "score"])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = shared.value
        for piece in W.slices(batches, text):
            coded = W.texts_of(piece, text).dictionary_encode()
            texts = coded.dictionary
            lang = np.full(len(texts), UNKNOWN, object)
            score = np.zeros(len(texts))
            spoken = np.flatnonzero(pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False))
            if names and len(spoken):
                # Rounded, so that what else a block holds can't decide.
                shares = np.round(label_shares(weights, texts.take(pa.array(spoken))), 5)
                best = shares.argmax(axis=1)
                lang[spoken] = np.array(names, object)[best]
                score[spoken] = np.minimum(shares[np.arange(len(spoken)), best], 1.0)
            at = coded.indices
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(lang, pa.string()).take(at), pa.array(score).take(at)],
                names=[*piece.schema.names, "lang_pred", "score"],
            )

    return docs.mapInArrow(run, schema)
