"""Text embedding with a pluggable encoder."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tablework.functions.text import word_buckets
from tablework.operators.numbering import SINGLE_TASK_ROWS, dense_ids

# Embedding width and encoder batch.
EMBEDDING_DIM = 384
BATCH_SIZE = 32


class Encoder(Protocol):
    """Anything that turns a list of texts into one vector per text."""

    def encode(self, texts: list[str]) -> np.ndarray: ...


@lru_cache(maxsize=100_000)
def _word_hash(word: str) -> int:
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16)


class HashedWords:
    """Default encoder: unit-length word counts over hashed buckets.

    A word is a run of a-z and 0-9 in the lower-cased text; its bucket is the
    first 32 bits of its md5 modulo the width, so the vectors can be reproduced
    in SQL. Columns are encoded by :func:`hashed_vectors`; this class encodes lists.
    """

    def __init__(self, dim: int = EMBEDDING_DIM):
        self.dim = dim

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, text in enumerate(texts):
            words = re.findall(r"[a-z0-9]+", text.lower())
            buckets = [_word_hash(w) % self.dim for w in words]
            if buckets:
                out[row] = np.bincount(buckets, minlength=self.dim)
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norms == 0, 1, norms)).astype(np.float32)


def hashed_vectors(rows: DataFrame, text: str, vector: str, dim: int = EMBEDDING_DIM) -> DataFrame:
    """``rows`` with the :class:`HashedWords` vector of a text.

    Spark ML counts the buckets and spreads them over the vector, which costs
    several times less than expressions on arrays that long.
    """
    from pyspark.ml.feature import CountVectorizerModel, Normalizer
    from pyspark.ml.functions import vector_to_array

    counter = CountVectorizerModel.from_vocabulary([str(b) for b in range(dim)], inputCol="__buckets", outputCol="__counts")
    unit = Normalizer(p=2.0, inputCol="__counts", outputCol="__unit")
    found = rows.withColumn("__buckets", word_buckets(text, dim).cast("array<string>"))
    return unit.transform(counter.transform(found)).select(
        *rows.columns, vector_to_array("__unit", "float32").cast("array<float>").alias(vector)
    )


def embed(
    df: DataFrame,
    keys: str | list[str],
    text: str,
    encoder: Callable[[], Encoder] = HashedWords,
    batch_size: int = BATCH_SIZE,
    tasks: int | None = None,
) -> DataFrame:
    """`(keys…, embedding, text)` for every row; one encoder per task.

    The default encoder runs in the JVM and needs no Python worker. Any other
    ``encoder`` is a picklable factory, called once in each Python worker task.
    Encoding costs far more than moving its texts: ``tasks`` spreads them by key
    when the input has too few partitions to keep the cluster busy.
    Vectors return as one Arrow buffer per batch, without an object per row.
    """
    keys = [keys] if isinstance(keys, str) else keys
    if encoder is HashedWords:
        rows = df.select(*keys, text)
        if tasks:
            rows = rows.repartition(tasks, *keys)
        vectors = hashed_vectors(rows, text, "embedding")
        return vectors.select(*keys, "embedding", F.col(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder()
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            parts = [
                np.asarray(model.encode(texts[start : start + batch_size]), np.float32)
                for start in range(0, len(texts), batch_size)
            ]
            matrix = np.concatenate(parts) if parts else np.empty((0, 0), np.float32)
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * matrix.shape[1]
            vectors = pa.ListArray.from_arrays(offsets, matrix.ravel())
            columns = [batch.column(k) for k in keys] + [vectors, batch.column(text)]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "embedding", "text"])

    schema = StructType(
        [StructField(k, df.schema[k].dataType) for k in keys]
        + [StructField("embedding", ArrayType(FloatType())), StructField("text", StringType())]
    )
    rows = df.select(*keys, text)
    if tasks:
        rows = rows.repartition(tasks, *keys)
    return rows.mapInArrow(encode, schema)


def vector_rows(
    texts: DataFrame,
    key: str,
    text: str,
    encoder: Callable[[], Encoder] = HashedWords,
    max_group: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Vector table: dense ids in key order, the key, and the vector of the text.

    Ids are given to the texts, before the much wider vectors exist.
    """
    keyed = texts.select(F.col(key).alias("order_id"), F.col(text).alias("text"))
    numbered = dense_ids(keyed, ["order_id"], "id", max_group)
    return embed(numbered, ["id", "order_id"], "text", encoder).select(
        "id", "order_id", F.col("embedding").alias("vector")
    )


def sparse_entries(embedded: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Non-zero entries as `(key, bucket, weight)` rows, found per Arrow batch."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(vector)
            flat = np.asarray(column.flatten(), dtype=np.float64)
            ends = np.asarray(column.offsets) - column.offsets[0].as_py()
            places = np.flatnonzero(flat)
            rows = np.searchsorted(ends, places, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(rows)), pa.array(places - ends[rows]), pa.array(flat[places])],
                [key, "bucket", "weight"],
            )

    schema = StructType(
        [
            StructField(key, embedded.schema[key].dataType),
            StructField("bucket", LongType()),
            StructField("weight", DoubleType()),
        ]
    )
    return embedded.select(key, vector).mapInArrow(entries, schema)
