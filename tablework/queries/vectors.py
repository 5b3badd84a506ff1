"""Embedding and similarity search."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.text import hashed_words, order_sentence
from tablework.operators.collection import create_collection, entity_count, insert_batch, read_collection, stored_centres
from tablework.operators.embedding import EMBEDDING_DIM
from tablework.operators.nearest import nearest_join
from tablework.operators.numbering import dense_ids
from tablework.operators.publish import stage
from tablework.operators.similarity import (
    Queries,
    assign_cells,
    parse_vectors,
    search,
    search_cells,
    train_centroids,
    vector_checks,
)
from tablework.operators.tree import assign_tree, search_tree, train_tree
from tablework.plans.search import (
    order_vectors,
    search_then_fetch,
    semantic_search,
    text_queries,
)
from tablework.queries.fixtures import (
    LANDING_SQL,
    VECTOR_SQL,
    label_centres,
    label_queries,
    landing,
    table,
    times_as_text,
)
from tablework.queries.registered import query
from tablework.runtime import scratch_path
from tablework.sinks.tables import write_collection, write_vectors
from tablework.sources.tables import read_vectors


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("vec/"), "vec_id").alias("order_id"),
        F.col("embedding").alias("vector"),
    )


def _label_batch(spark: SparkSession, sf_dir: str) -> Queries:
    return Queries.of(label_queries(spark, sf_dir), "query_id", "vector")


def _centres(spark: SparkSession, sf_dir: str) -> np.ndarray:
    batch = Queries.of(label_centres(spark, sf_dir), "centre", "vector")
    return batch.matrix[np.argsort(batch.ids)]


def _ranked_sql(score: str, order: str) -> str:
    return f"""WITH {VECTOR_SQL},
    scored AS (SELECT query_id, id, {score} AS score FROM q, e)
    SELECT query_id, rank, id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, id)::INTEGER AS rank
      FROM scored) WHERE rank <= 5"""


COSINE_SQL = _ranked_sql("round(list_cosine_similarity(ev, qv), 6)", "DESC")


@query(COSINE_SQL)
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_stored(spark, sf_dir), _label_batch(spark, sf_dir))


@query(_ranked_sql("round(list_distance(ev, qv), 6)", "ASC"))
def l2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_stored(spark, sf_dir), _label_batch(spark, sf_dir), metric="l2")


@query(_ranked_sql("round(list_dot_product(ev, qv), 6)", "DESC"))
def ip_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_stored(spark, sf_dir), _label_batch(spark, sf_dir), metric="ip")


CELL_SQL = f"""{VECTOR_SQL},
cells AS (SELECT id, cell FROM (
  SELECT id, cell, row_number() OVER (PARTITION BY id
         ORDER BY round(list_cosine_similarity(ev, cv), 6) DESC, cell) AS rn FROM e, c) WHERE rn = 1),
probes AS (SELECT query_id, cell FROM (
  SELECT query_id, cell, row_number() OVER (PARTITION BY query_id
         ORDER BY round(list_cosine_similarity(qv, cv), 6) DESC, cell) AS rn FROM q, c) WHERE rn <= 4)"""


@query(f"WITH {CELL_SQL} SELECT id, cell::INTEGER AS cell FROM cells")
def cell_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_cells(_stored(spark, sf_dir), _centres(spark, sf_dir)).select("id", "cell")


@query(
    f"""WITH {CELL_SQL},
    scored AS (SELECT query_id, id, round(list_cosine_similarity(ev, qv), 6) AS score
               FROM q JOIN probes USING (query_id) JOIN cells USING (cell) JOIN e USING (id))
    SELECT query_id, rank, id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank
      FROM scored) WHERE rank <= 5"""
)
def cell_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four probed cells per query, read from a collection stored by cell."""
    centres = _centres(spark, sf_dir)
    path = scratch_path(spark, "collection")
    write_collection(assign_cells(_stored(spark, sf_dir), centres), path, dim=64)
    return search_cells(spark.read.parquet(path), _label_batch(spark, sf_dir), centres, nprobe=4)


@query(COSINE_SQL)
def cell_search_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained cells; with every cell probed the result is that of exact search."""
    vectors = _stored(spark, sf_dir)
    centres = train_centroids(vectors, nlist=16)
    indexed = assign_cells(vectors, centres)
    return search_cells(indexed, _label_batch(spark, sf_dir), centres, nprobe=len(centres))


def _grown_collection(spark: SparkSession, sf_dir: str) -> tuple[str, list[dict[str, int]]]:
    """A collection that all vectors enter in three batches, with rows that must not enter among them."""
    path = scratch_path(spark, "collection")
    create_collection(spark, path, _centres(spark, sf_dir))
    stored = _stored(spark, sf_dir)
    again = stored.where("id % 30 = 0").withColumn("order_id", F.concat(F.lit("x/"), "order_id"))
    narrow = stored.where("id % 50 = 1").select(
        (F.col("id") + 1_000_000_000).alias("id"), "order_id", F.slice("vector", 1, 63).alias("vector")
    )
    # Rows of the first batch come again in the second and, twice, in their own batch; narrow ones in the third.
    batches = [
        stored.where("id % 3 = 0").unionByName(again),
        stored.where("id % 3 = 1").unionByName(again),
        stored.where("id % 3 = 2").unionByName(narrow),
    ]
    return path, [
        {"batch": n, **insert_batch(spark, path, batch, n, dim=64), "entities": entity_count(spark, path)}
        for n, batch in enumerate(batches)
    ]


@query(
    """WITH b AS (
      SELECT vec_id % 3 AS batch, count(*) AS inserted FROM embeddings GROUP BY 1),
    extra AS (SELECT count(*) FILTER (vec_id % 30 = 0) AS again, count(*) FILTER (vec_id % 50 = 1) AS narrow FROM embeddings)
    SELECT batch::BIGINT AS batch,
           (inserted + CASE WHEN batch < 2 THEN again ELSE narrow END)::BIGINT AS offered, inserted::BIGINT AS inserted,
           (CASE WHEN batch = 1 THEN again ELSE 0 END)::BIGINT AS known,
           (CASE WHEN batch = 0 THEN again ELSE 0 END)::BIGINT AS repeated,
           (CASE WHEN batch = 2 THEN narrow ELSE 0 END)::BIGINT AS unfit,
           sum(inserted) OVER (ORDER BY batch)::BIGINT AS entities
    FROM b, extra"""
)
def collection_insert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three inserts into a stored collection took and refused, and its entities after each."""
    reports = _grown_collection(spark, sf_dir)[1]
    columns = ["batch", "offered", "inserted", "known", "repeated", "unfit", "entities"]
    rows = [tuple(r[c] for c in columns) for r in reports]
    return spark.createDataFrame(rows, ", ".join(f"{c} bigint" for c in columns))


@query(COSINE_SQL)
def collection_insert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells of a collection that grew by batches; the result is that of exact search."""
    path = _grown_collection(spark, sf_dir)[0]
    centres = stored_centres(spark, path)
    return search_cells(read_collection(spark, path), _label_batch(spark, sf_dir), centres, nprobe=len(centres))


def _many_sql(score: str, order: str) -> str:
    return f"""WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
    scored AS (SELECT q.id AS query_id, e.id, {score} AS score FROM e q, e)
    SELECT query_id, rank, id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, id)::INTEGER AS rank
      FROM scored) WHERE rank <= 5"""


def _every_vector(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    stored = stage(spark, _stored(spark, sf_dir))
    asked = stored.select(F.col("id").alias("query_id"), "vector")
    return nearest_join(stored, asked, train_centroids(stored, nlist=64), metric=metric).hits


@query(_many_sql("round(list_cosine_similarity(e.v, q.v), 6)", "DESC"))
def cosine_topk_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a query against all vectors."""
    return _every_vector(spark, sf_dir, "cosine")


@query(_many_sql("round(list_distance(e.v, q.v), 6)", "ASC"))
def l2_topk_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _every_vector(spark, sf_dir, "l2")


@query(
    """SELECT count(*) AS n_vectors, count(*) FILTER (len(embedding) <> 64)::BIGINT AS wrong_dim,
           count(*) - count(DISTINCT vec_id) AS duplicate_ids,
           max(length('vec/' || vec_id))::INTEGER AS max_key_length
    FROM embeddings"""
)
def collection_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_checks(_stored(spark, sf_dir), dim=64)


@query(
    """SELECT vec_id, len(embedding)::INTEGER AS width, round(list_sum(embedding::DOUBLE[]), 6) AS total,
           label FROM embeddings"""
)
def vector_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors rendered as text and parsed again."""
    text = F.to_json("embedding")
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", "label", parse_vectors(text).alias("vector"))
        .select("vec_id", F.size("vector").alias("width"), F.round(total, 6).alias("total"), "label")
    )


@query(
    f"""WITH {LANDING_SQL}
    SELECT "OrderId", row_number() OVER (ORDER BY "OrderId") - 1 AS id FROM landing"""
)
def vector_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_ids(landing(spark, sf_dir).select("OrderId"), ["OrderId"])


@query(
    f"""WITH {CELL_SQL},
    kept AS (SELECT vec_id AS id, 'vec/' || vec_id AS order_id, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings)
    SELECT p.place, id, order_id, total, CASE p.place WHEN 'collection' THEN cell ELSE -1 END::INTEGER AS cell
    FROM kept JOIN cells USING (id), (VALUES ('first'), ('second'), ('collection')) AS p(place)"""
)
def vector_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as it lies at two places and in a collection stored by cell."""
    first, second = scratch_path(spark, "import"), scratch_path(spark, "vectors")
    collection = scratch_path(spark, "collection")
    write_vectors(_stored(spark, sf_dir), first, second)
    stored = read_vectors(spark, first)
    write_collection(assign_cells(stored, _centres(spark, sf_dir)), collection, dim=64)
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double"))
    places = {
        "first": stored.withColumn("cell", F.lit(-1)),
        "second": read_vectors(spark, second).withColumn("cell", F.lit(-1)),
        "collection": spark.read.parquet(collection),
    }
    rows = [
        found.select(F.lit(place).alias("place"), "id", "order_id", F.round(total, 6).alias("total"), F.col("cell").cast("int").alias("cell"))
        for place, found in places.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query(COSINE_SQL)
def cell_search_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells below coarse cells, large ones split again; all of them probed give exact search."""
    vectors = stage(spark, _stored(spark, sf_dir))
    tree = train_tree(vectors, coarse=4, fine=4, max_rows=20_000)
    indexed = assign_tree(vectors, tree)
    return search_tree(indexed, _label_batch(spark, sf_dir), tree, nprobe=tree.leaves)


SENTENCE_SQL = """'Order ' || "OrderId" || '. Customer: ' || "CustomerId" || '. Status: ' || "Status"
  || '. Amount: $' || "TotalAmount"::DECIMAL(18,2)::VARCHAR || '. Ship to: ' || "ShipCity" || ', '
  || "ShipCountry" || '. Items: ' || "LineCount" || ' line items'"""


def _weights_sql(name: str, key: str, text: str, source: str) -> str:
    """Hashed word weights of a text column as CTEs ending in ``name``."""
    return f"""
{name}_words AS (SELECT {key}, unnest(string_split_regex(lower({text}), '[^a-z0-9]+')) AS w FROM {source}),
{name}_counts AS (SELECT {key}, ('0x' || substr(md5(w), 1, 8))::BIGINT % 384 AS bucket, count(*) AS c
  FROM {name}_words WHERE w <> '' GROUP BY ALL),
{name} AS (SELECT {key}, bucket,
  (c / sqrt(sum(c * c) OVER (PARTITION BY {key})))::FLOAT::DOUBLE AS weight FROM {name}_counts)"""


ORDER_WEIGHTS_SQL = f"""{LANDING_SQL},
texts AS (SELECT "OrderId" AS order_id, {SENTENCE_SQL} AS sentence FROM landing),
{_weights_sql("weights", "order_id", "sentence", "texts")}"""


@query(f"WITH {ORDER_WEIGHTS_SQL} SELECT order_id, bucket, round(weight, 6) AS weight FROM weights")
def embed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of all orders, as their non-zero entries."""
    entries = hashed_words(order_sentence(), EMBEDDING_DIM)
    rows = landing(spark, sf_dir).select(F.col("OrderId").alias("order_id"), F.inline(entries))
    return rows.withColumn("weight", F.round(F.col("weight").cast("double"), 6))


SEARCH_SQL = f"""{ORDER_WEIGHTS_SQL},
asked AS (SELECT row_number() OVER (ORDER BY "Status", "ShipCountry") - 1 AS query_id,
                 'orders with status ' || "Status" || ' shipped to ' || "ShipCountry" AS question
          FROM (SELECT DISTINCT "Status", "ShipCountry" FROM landing)),
{_weights_sql("asked_weights", "query_id", "question", "asked")},
ids AS (SELECT order_id, row_number() OVER (ORDER BY order_id) - 1 AS id FROM texts),
asked_norm AS (SELECT query_id, sqrt(sum(weight * weight)) AS norm FROM asked_weights GROUP BY 1),
norms AS (SELECT order_id, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY 1),
dots AS (SELECT a.query_id, w.order_id, sum(a.weight * w.weight) AS dot
         FROM asked_weights a JOIN weights w USING (bucket) GROUP BY ALL),
scored AS (SELECT d.query_id, i.id, d.order_id, round(dot / (a.norm * n.norm), 6) AS score
           FROM dots d JOIN asked_norm a USING (query_id) JOIN norms n USING (order_id)
           JOIN ids i USING (order_id)),
hits AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank
  FROM scored) WHERE rank <= 5)"""


def _questions(orders: DataFrame) -> Queries:
    """One question per status and country that occurs."""
    asked = dense_ids(
        orders.select("Status", "ShipCountry").distinct(),
        ["Status", "ShipCountry"],
        "query_id",
    )
    text = F.concat(F.lit("orders with status "), "Status", F.lit(" shipped to "), "ShipCountry")
    return text_queries(asked.select("query_id", text.alias("question")), "query_id", "question")


@query(f"WITH {SEARCH_SQL} SELECT query_id, rank, id, order_id, score FROM hits")
def semantic_search_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stage(spark, landing(spark, sf_dir))
    return semantic_search(stage(spark, order_vectors(orders)), _questions(orders))


@query(
    f"""WITH {SEARCH_SQL}
    SELECT query_id, rank, score, "OrderId", "CustomerId",
           strftime("OrderDate", '%Y-%m-%d %H:%M:%S') AS "OrderDate", "TotalAmount", "Status",
           "ShipCity", "ShipCountry", "LineCount", strftime("SyncedAt", '%Y-%m-%d %H:%M:%S') AS "SyncedAt"
    FROM hits JOIN landing ON order_id = "OrderId" """
)
def search_then_fetch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stage(spark, landing(spark, sf_dir))
    vectors = stage(spark, order_vectors(orders))
    return times_as_text(search_then_fetch(vectors, orders, _questions(orders)))
