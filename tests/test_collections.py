import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.functions.text import dense_vector, hashed_words
from tablework.operators import collection, nearest, tree
from tablework.operators.embedding import EMBEDDING_DIM, HashedWords, embed
from tablework.operators.similarity import Queries, assign_cells, search, search_cells, train_centroids
from tablework.plans.search import semantic_search
from tablework.runtime import scratch_path

VECTOR = "id bigint, order_id string, vector array<float>"


def vectors(spark, n=400, dim=8, seed=1, groups=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim)) * 3
    rows = [(i, f"k{i}", [float(x) for x in np.float32(centres[i % groups] + rng.normal(0, 0.4, dim))]) for i in range(n)]
    return spark.createDataFrame(rows, VECTOR).repartition(5)


def ordered(df):
    return sorted(tuple(r) for r in df.collect())


# --- stored collection


def test_inserts_count_refuse_and_replace(spark):
    path = scratch_path(spark, "collection")
    rows = vectors(spark)
    collection.create_collection(spark, path, train_centroids(rows, 6))
    first = rows.where("id < 200")
    report = {"offered": 200, "inserted": 200, "known": 0, "repeated": 0, "unfit": 0}
    assert collection.insert_batch(spark, path, first, 0, 8) == report
    # The same number again replaces the batch, another number refuses its rows.
    assert collection.insert_batch(spark, path, first, 0, 8) == report
    assert collection.insert_batch(spark, path, first, 1, 8) == {**report, "inserted": 0, "known": 200}
    bad = spark.createDataFrame(
        [(900, "a", None), (901, "b", [1.0] * 7), (None, "c", [1.0] * 8), (902, "k" * 101, [1.0] * 8), (903, "d", [1.0] * 7 + [None]),
         (904, "z", [2.0] * 8), (904, "y", [1.0] * 8), (904, "y", [0.5] * 8), (905, None, [1.0] * 8)],
        VECTOR,
    )
    assert collection.insert_batch(spark, path, bad, 2, 8) == {"offered": 9, "inserted": 2, "known": 0, "repeated": 2, "unfit": 5}
    assert collection.insert_batch(spark, path, bad.limit(0), 3, 8) == dict.fromkeys(report, 0)
    stored = collection.read_collection(spark, path)
    assert collection.entity_count(spark, path) == stored.count() == 202
    assert [(r.order_id, r.vector[0]) for r in stored.where("id = 904").collect()] == [("y", 0.5)]
    counts = collection.cell_counts(spark, path).groupBy("cell").agg(F.sum("n").alias("n"))
    assert ordered(counts) == ordered(stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n")))


def test_insert_matches_ids_only(spark, plan):
    path = scratch_path(spark, "collection")
    rows = vectors(spark, 50)
    collection.create_collection(spark, path, train_centroids(rows, 3))
    collection.insert_batch(spark, path, rows, 0, 8)
    stored = collection.read_collection(spark, path).where("batch <> 1").select("id")
    text = plan(stored)
    assert "ReadSchema: struct<id:bigint>" in text and "PartitionFilters: [isnotnull(batch" in text


def test_search_after_inserts(spark):
    path = scratch_path(spark, "collection")
    rows = vectors(spark)
    collection.create_collection(spark, path, train_centroids(rows.where("id < 100"), 6))
    for n in range(3):
        collection.insert_batch(spark, path, rows.where(f"id % 3 = {n}"), n, 8)
    queries = Queries.of(rows.where("id % 40 = 0"), "id", "vector")
    centres = collection.stored_centres(spark, path)
    found = search_cells(collection.read_collection(spark, path), queries, centres, nprobe=len(centres))
    assert ordered(found) == ordered(search(rows, queries))


# --- nearest join


def test_queries_that_keep_all_rings_travel_once_per_block(spark):
    # In 64 dimensions the triangle inequality drops nothing; a query row per ring would be 8 * 6 of them.
    random = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, "k", random.normal(size=64).tolist()) for i in range(400)], VECTOR)
    asked = rows.select(F.col("id").alias("query_id"), "vector")
    pivots = random.normal(size=(6, 64))
    placed, rings = nearest.in_rings(rows, pivots, "l2", "id", "vector")
    bounded = asked.withColumn("kth", F.lit(None).cast("double"))
    for block_rows in (100, 15):
        first, split = rings.blocks(block_rows)
        blocks = int((first + split).max())
        probes = nearest._other_rings(bounded, pivots, rings, 5, "l2", 6, block_rows)
        assert probes.groupBy("query_id").count().agg(F.max("count")).first()[0] <= blocks
        assert blocks <= 400 / block_rows * 2 + 1
    for metric in ("cosine", "l2"):
        plain = ordered(search(rows, Queries.of(asked, "query_id", "vector"), 5, metric))
        for block_rows in (15, 8_000):
            found = nearest.nearest_join(rows, asked, pivots, 5, metric, block_rows=block_rows)
            assert ordered(found.hits) == plain
            assert found.pairs_visited() <= 400 * 400


def test_ties_are_cut_while_they_are_found(monkeypatch):
    from tablework.operators import similarity

    monkeypatch.setattr(similarity, "HELD_HITS", 100)
    most = []
    cut = similarity._Best._cut
    monkeypatch.setattr(similarity._Best, "_cut", lambda self: (most.append(len(self.query)), cut(self)))
    for metric in ("cosine", "l2"):
        best = similarity._Best(np.ones((2_500, 2)), 5, metric, 6)
        for start in range(0, 4_000, 2_000):
            best.add(np.arange(start, start + 2_000), np.ones((2_000, 2)), None)
        assert sorted(set(best.id.tolist())) == [0, 1, 2, 3, 4]
    assert max(most) <= 4_000_000 + 100 + 5 * 2_500


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_nearest_join_is_exact_and_skips_pairs(spark, metric):
    rows = vectors(spark, 600, groups=20)
    queries = rows.select(F.col("id").alias("query_id"), "vector")
    found = nearest.nearest_join(rows, queries, train_centroids(rows, 20), 5, metric)
    plain = search(rows, Queries.of(queries, "query_id", "vector"), 5, metric)
    assert ordered(found.hits) == ordered(plain)
    assert found.pairs_visited() < 0.65 * 600 * 600


def test_nearest_join_of_odd_vectors(spark):
    rows = spark.createDataFrame(
        [(i, "k", v) for i, v in enumerate([[0.0, 0.0], [1.0, 0.0], [1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [2.0, 0.0], [0.0, 0.0]])], VECTOR
    )
    queries = rows.select(F.col("id").alias("query_id"), "vector")
    for k in (1, 3, 50):
        for pivots in (np.array([[1.0, 0.0]]), np.array([[1.0, 0.1], [0.0, 1.0], [-1.0, -1.0]])):
            found = nearest.nearest_join(rows, queries, pivots, k).hits
            assert ordered(found) == ordered(search(rows, Queries.of(queries, "query_id", "vector"), k))
    assert nearest.nearest_join(rows, queries.limit(0), pivots).hits.count() == 0
    assert nearest.nearest_join(rows.limit(0), queries, pivots).hits.count() == 0
    with pytest.raises(ValueError):
        nearest.nearest_join(rows, queries, pivots, metric="ip")


# --- cell tree


def test_tree_is_exact_with_all_leaves_and_recalls_with_some(spark):
    rows = vectors(spark, 800, groups=16)
    grown = tree.train_tree(rows, coarse=4, fine=4, max_rows=60)
    indexed = tree.assign_tree(rows, grown).cache()
    sizes = [r["count"] for r in indexed.groupBy("cell").count().collect()]
    assert grown.leaves > 16 and max(sizes) <= 60 * 3 and sum(sizes) == 800
    queries = Queries.of(rows.where("id % 10 = 0"), "id", "vector")
    exact = search(rows, queries, 5)
    assert ordered(tree.search_tree(indexed, queries, grown, grown.leaves)) == ordered(exact)
    some = tree.search_tree(indexed, queries, grown, max(1, grown.leaves // 4))
    near = {(r.query_id, r.id) for r in exact.collect()}
    assert len(near & {(r.query_id, r.id) for r in some.collect()}) >= 0.9 * len(near)
    many = Queries(queries.frame, None, None)
    assert ordered(tree.search_tree(indexed, many, grown, 3)) == ordered(tree.search_tree(indexed, queries, grown, 3))


def test_tree_meets_centres_below_its_coarse_one_only():
    grown = tree._numbered(
        tree.CellTree({0: [1, 2], 1: [3, 4]}, {0: np.array([[1.0, 0.0], [0.0, 1.0]]), 1: np.array([[1.0, 0.1], [1.0, -0.1]])})
    )
    assert grown.leaf == {2: 0, 3: 1, 4: 2}
    node, leaf = grown.place(np.array([[0.0, 5.0], [3.0, 1.0], [3.0, -1.0], [0.0, 0.0]]), 6)
    assert leaf.tolist() == [0, 1, 2, 1]
    assert grown.probed(np.array([[3.0, 1.0]]), 2, 6)[:, 0].tolist() == [False, True, True]


def test_tree_of_missing_and_equal_vectors(spark):
    rows = spark.createDataFrame([(1, "a", None), *[(i, "b", [1.0, 2.0]) for i in range(2, 40)]], VECTOR)
    grown = tree.train_tree(rows, coarse=3, fine=2, max_rows=5)
    cells = {r.id: r.cell for r in tree.assign_tree(rows, grown).collect()}
    assert cells[1] is None and len({c for i, c in cells.items() if i > 1}) == 1
    assert tree.train_tree(rows.limit(0)).leaves == 1


# --- expression encoder

TEXTS = ["One, two; ONE", "", None, "two one one", "ÄÖ a-b_c 12 12 12", "x " * 500, "Order orders/1. Customer: customers/7"]


def test_hashed_words_equal_the_list_encoder(spark, plan):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(2)
    for dim in (16, EMBEDDING_DIM):
        wanted = HashedWords(dim).encode([t or "" for t in TEXTS])
        dense = rows.select("id", dense_vector(hashed_words("text", dim), dim).alias("v"))
        for row in dense.collect():
            assert row.v == [float(x) for x in wanted[row.id]]
    embedded = embed(rows, "id", "text")
    text = plan(embedded)
    assert "EvalPython" not in text and "Arrow" not in text and embedded.columns == ["id", "embedding", "text"]


def test_hashed_vectors_need_no_long_array_expressions(spark, plan):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(2)
    text = plan(embed(rows, "id", "text"))
    assert "flatten(" not in text and "array_repeat(" not in text
    wanted = HashedWords().encode([t or "" for t in TEXTS])
    for row in embed(rows, "id", "text").collect():
        assert row.embedding == [float(x) for x in wanted[row.id]]


def test_hits_carry_their_key_in_one_scan(spark, plan):
    rows = vectors(spark, 60)
    path = scratch_path(spark, "vectors")
    rows.write.parquet(path)
    stored = spark.read.schema(VECTOR).parquet(path)
    queries = Queries.of(rows.where("id < 4"), "id", "vector")
    hits = semantic_search(stored, queries)
    assert plan(hits, "simple").count("FileScan parquet") == 1
    assert all(r.order_id == f"k{r.id}" for r in hits.collect())
    many = semantic_search(stored, Queries(queries.frame, None, None))
    assert ordered(many) == ordered(hits)
    centres = train_centroids(rows, 4)
    by_cells = semantic_search(assign_cells(stored, centres), queries, centroids=centres, nprobe=4)
    assert ordered(by_cells) == ordered(hits)
