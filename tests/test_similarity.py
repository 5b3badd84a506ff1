"""Search against brute force, on every route."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.operators import similarity
from tablework.operators.embedding import HashedWords, embed, vector_rows
from tablework.operators.similarity import (
    Queries,
    assign_cells,
    parse_vectors,
    require_collection,
    search,
    search_cells,
    train_centroids,
    vector_checks,
)
from tablework.plans.search import order_vectors, search_then_fetch, text_queries
from tablework.schemas import VECTORS

DIM, N, Q, K = 8, 600, 23, 4


@pytest.fixture(scope="module")
def data(spark):
    """Vectors of which a third are copies of one, and some queries."""
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(N, DIM)).astype(np.float32)
    matrix[::3] = matrix[0]
    asked = rng.normal(size=(Q, DIM)).astype(np.float32)
    asked[0] = matrix[0]
    vectors = spark.createDataFrame(
        [(i, f"o{i}", [float(x) for x in row]) for i, row in enumerate(matrix)], VECTORS
    ).repartition(5)
    queries = spark.createDataFrame(
        [(100 + i, [float(x) for x in row]) for i, row in enumerate(asked)], "q bigint, v array<float>"
    )
    return matrix.astype(float), asked.astype(float), vectors, queries


def brute(matrix, asked, metric, allowed=None):
    out = {}
    for j, q in enumerate(asked):
        if metric == "cosine":
            score = matrix @ q / np.linalg.norm(matrix, axis=1) / np.linalg.norm(q)
        elif metric == "ip":
            score = matrix @ q
        else:
            score = -np.linalg.norm(matrix - q, axis=1)
        score = np.round(score, 6)
        ids = [i for i in range(len(matrix)) if allowed is None or allowed(i, j)]
        best = sorted(ids, key=lambda i: (-score[i], i))[:K]
        out[100 + j] = [(i, round(abs(score[i]) if metric == "l2" else score[i], 6)) for i in best]
    return out


def collected(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["id"], round(r["score"], 6)))
    return out


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
@pytest.mark.parametrize("route", ["broadcast", "blocks"])
def test_exact_search(data, monkeypatch, metric, route):
    matrix, asked, vectors, queries = data
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 50)
    batch = Queries.of(queries, "q", "v", max_rows=1_000 if route == "broadcast" else 5)
    assert batch.small == (route == "broadcast")
    assert collected(search(vectors, batch, K, metric)) == brute(matrix, asked, metric)


@pytest.mark.parametrize("route", ["broadcast", "blocks"])
@pytest.mark.parametrize("nprobe", [2, 6])
def test_cell_search(data, monkeypatch, route, nprobe):
    matrix, asked, vectors, queries = data
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 50)
    centres = matrix[1:7]
    unit = centres / np.linalg.norm(centres, axis=1, keepdims=True)

    def cosines(rows):
        return np.round(rows / np.linalg.norm(rows, axis=1, keepdims=True) @ unit.T, 6)

    cell = cosines(matrix).argmax(axis=1)
    probed = np.argsort(-cosines(asked), axis=1, kind="stable")[:, :nprobe]
    indexed = assign_cells(vectors, centres)
    assert {r["id"]: r["cell"] for r in indexed.collect()} == dict(enumerate(cell))
    batch = Queries.of(queries, "q", "v", max_rows=1_000 if route == "broadcast" else 5)
    found = collected(search_cells(indexed, batch, centres, K, nprobe))
    assert found == brute(matrix, asked, "cosine", lambda i, j: cell[i] in probed[j])
    if nprobe == 6:
        assert found == brute(matrix, asked, "cosine")


def test_training_reads_and_assigns_every_row(data):
    _, _, vectors, _ = data
    centres = train_centroids(vectors, nlist=5)
    assert centres.shape[1] == DIM and len(centres) <= 5
    whole = {r["id"]: r["cell"] for r in assign_cells(vectors, centres).collect()}
    assert len(whole) == N and None not in whole.values()
    blocks = assign_cells(vectors, centres, floats_at_once=2 * DIM)
    assert {r["id"]: r["cell"] for r in blocks.collect()} == whole


def test_missing_vectors_and_empty_batches(spark, data):
    matrix, _, vectors, queries = data
    row = vectors.limit(1).withColumn("vector", F.lit(None).cast("array<float>"))
    cells = [r["cell"] for r in assign_cells(row, matrix[:3]).collect()]
    assert cells == [None]
    assert [r["cell"] for r in assign_cells(row, matrix[:3], floats_at_once=DIM).collect()] == [None]
    none = Queries.of(queries.limit(0), "q", "v")
    assert search(vectors, none, K).count() == 0
    indexed = assign_cells(vectors, matrix[:3])
    assert search_cells(indexed, none, matrix[:3], K, 2).count() == 0


def test_search_never_shuffles_vectors(data, plan):
    _, _, vectors, queries = data
    text = plan(search(vectors, Queries.of(queries, "q", "v"), K), "simple")
    assert text.count("WindowGroupLimit") == 2 and "Cartesian" not in text and "NestedLoop" not in text


def test_stored_cells_are_pruned(spark, data, plan):
    from tablework.runtime import scratch_path
    from tablework.sinks.tables import write_collection

    matrix, _, vectors, queries = data
    path = scratch_path(spark, "collection")
    assert write_collection(assign_cells(vectors, matrix[1:7]), path, DIM) == N
    one = Queries.of(queries.where("q = 100"), "q", "v")
    text = plan(search_cells(spark.read.parquet(path), one, matrix[1:7], K, nprobe=1))
    assert "cell" in text.split("PartitionFilters:")[1].split("\n")[0]


def test_wrong_width_fails(spark):
    bad = spark.createDataFrame([(1, "a", [1.0, 2.0]), (2, "b", [1.0])], VECTORS)
    batch = Queries.of(spark.createDataFrame([(1, [1.0, 0.0])], "q bigint, v array<float>"), "q", "v")
    with pytest.raises(Exception, match="not of width 2"):
        search(bad, batch).collect()


def test_collection_checks(spark):
    rows = [(1, "a", [1.0, 2.0]), (1, "b", [1.0]), (2, "x" * 101, None), (3, None, [1.0, 2.0])]
    bad = spark.createDataFrame(rows, VECTORS)
    assert vector_checks(bad, 2).first().asDict() == {
        "n_vectors": 4, "wrong_dim": 2, "duplicate_ids": 1, "max_key_length": 101,
    }
    with pytest.raises(ValueError, match="duplicate_ids"):
        require_collection(bad, 2)
    assert require_collection(bad.where("id = 3"), 2) == 1


def test_parse_vectors(spark):
    df = spark.createDataFrame([("[1.0, 2.5]",), ("[]",), ("oops",)], "t string")
    assert [r[0] for r in df.select(parse_vectors("t")).collect()] == [[1.0, 2.5], [], None]


class Counting:
    """Encoder that writes down the size of each batch it got."""

    def encode(self, texts):
        return np.array([[len(texts), len(t)] for t in texts], dtype=np.float32)


def test_embedding_batches_and_custom_encoder(spark):
    df = spark.createDataFrame([(f"k{i}", "x" * i) for i in range(70)], "k string, t string").coalesce(1)
    rows = embed(df, "k", "t", Counting).collect()
    assert sorted({r["embedding"][0] for r in rows}) == [6.0, 32.0]
    assert {r["k"]: r["embedding"][1] for r in rows} == {f"k{i}": float(i) for i in range(70)}
    assert {r["text"] for r in rows} == {"x" * i for i in range(70)}


def test_hashed_words():
    vectors = HashedWords(16).encode(["One, two; ONE", "", "two one one"])
    assert np.allclose(vectors[0], vectors[2]) and not vectors[1].any()
    assert np.isclose(np.linalg.norm(vectors[0]), 1)


def test_vector_rows_are_dense(spark):
    df = spark.createDataFrame([(f"k{i}", "t") for i in range(9)], "k string, t string")
    rows = vector_rows(df, "k", "t", Counting, max_group=3).orderBy("id").collect()
    assert [(r["id"], r["order_id"]) for r in rows] == [(i, f"k{i}") for i in range(9)]


def test_search_then_fetch_keeps_rank(spark):
    from tests.test_orders import orders

    rows = orders(spark, [("alpha", "Pending", 1, 1), ("beta", "Cancelled", 1, 1), ("gamma", "Pending", 1, 1)])
    asked = spark.createDataFrame([(7, "cancelled orders")], "q bigint, t string")
    found = search_then_fetch(order_vectors(rows), rows, text_queries(asked, "q", "t"), k=3)
    ranked = [(r["rank"], r["OrderId"]) for r in found.orderBy("rank").collect()]
    assert ranked[0] == (1, "beta") and len(ranked) == 3
    assert {"query_id", "score", "Status"} <= set(found.columns)


def test_hits_are_joined_without_shuffling_rows(spark, data, plan):
    _, _, vectors, queries = data
    batch = Queries.of(queries, "q", "v")
    hits = search(vectors, batch, K)
    rows = vectors.select(F.col("id").alias("row_id"), "order_id")
    text = plan(similarity.fetch_hits(hits, rows, "id", "row_id", Q * K), "simple")
    assert "BroadcastHashJoin" in text
