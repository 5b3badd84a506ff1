"""Orders to vectors, and text queries to orders.

Searches read vectors more than once, so store them first (see the vector sinks).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.text import order_sentence
from tablework.operators.embedding import Encoder, HashedWords, embed, vector_rows
from tablework.operators.similarity import (
    NPROBE,
    TOP_K,
    Queries,
    fetch_hits,
    search,
    search_cells,
)


def order_vectors(
    orders: DataFrame, encoder: Callable[[], Encoder] = HashedWords
) -> DataFrame:
    """Vector table of flat orders: `(id, order_id, vector)`."""
    texts = orders.select(F.col("OrderId").alias("order_id"), order_sentence().alias("sentence"))
    return vector_rows(texts, "order_id", "sentence", encoder)


def text_queries(
    queries: DataFrame,
    id_col: str,
    text_col: str,
    encoder: Callable[[], Encoder] = HashedWords,
) -> Queries:
    return Queries.of(embed(queries, id_col, text_col, encoder), id_col, "embedding")


def semantic_search(
    vectors: DataFrame,
    queries: Queries,
    k: int = TOP_K,
    centroids: np.ndarray | None = None,
    nprobe: int = NPROBE,
) -> DataFrame:
    """`(query_id, rank, order_id, score)`; by cells when centroids are given."""
    if centroids is None:
        hits = search(vectors, queries, k, key_col="order_id")
    else:
        hits = search_cells(vectors, queries, centroids, k, nprobe, key_col="order_id")
    return hits.select("query_id", "rank", "id", F.col("key").alias("order_id"), "score")


def search_then_fetch(
    vectors: DataFrame, orders: DataFrame, queries: Queries, k: int = TOP_K, **options
) -> DataFrame:
    """Hits with the full order beside rank and score, best first within a query."""
    hits = semantic_search(vectors, queries, k, **options)
    rows = fetch_hits(hits, orders, "order_id", "OrderId", _bound(queries, k))
    return rows.select("query_id", "rank", "score", *orders.columns)


def _bound(queries: Queries, k: int) -> int | None:
    return len(queries.ids) * k if queries.small else None
