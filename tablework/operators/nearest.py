"""Exact nearest neighbours of many queries, with blocks dropped by the triangle inequality.

Vectors are assigned to their nearest pivot and, by their distance to it, to one
of ``RINGS`` rings of the pivot's cell; per ring the smallest and the greatest
distance are known. A query first searches the rings nearest to it until they
hold ``k`` rows. Its k-th score then bounds all others: a ring can only hold a
better row when the query's distance to the pivot is no farther from the ring
than the k-th hit is from the query. Remaining rings are searched, the others
never meet the query. Nothing is lost: distances are angles (cosine) or Euclidean
(l2), which are metrics, and ties at the rounded score stay inside the bound.

Many queries keep most rings (in many dimensions all are about equally far), so
rings are packed into blocks of about ``MEET_ROWS`` rows and a query is sent once
to a block, with the rings of it that it needs. What a task holds is then one
block of vectors, one of queries and their best hits, however many rings remain.

Zero vectors have no angle; they form a part of their own that every query
visits, and a zero query visits all parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.operators.numbering import first_per_group
from tablework.operators.publish import stage
from tablework.operators.similarity import _HIT, TOP_K, _Best, _blocks, _matrix, _unit

#: Rings of a pivot's cell.
RINGS = 8
#: Part of the rows without an angle.
ZERO = -1
#: Vectors, and queries, that meet in one task once the k-th score is known.
MEET_ROWS = 8_000
#: (query, ring) numbers that a task works out at once.
CHOSEN_AT_ONCE = 500_000


def _distances(vectors: np.ndarray, pivots: np.ndarray, metric: str) -> np.ndarray:
    """(vectors x pivots) angles or Euclidean distances."""
    if metric == "cosine":
        return np.arccos(np.clip(_unit(vectors) @ _unit(pivots).T, -1, 1))
    return np.stack([np.linalg.norm(vectors - p, axis=1) for p in pivots], axis=1)


def _reach(score: np.ndarray, metric: str, decimals: int) -> np.ndarray:
    """The distance within which a row can still get ``score`` after rounding."""
    slack = 10.0**-decimals
    if metric == "cosine":
        return np.arccos(np.clip(score - slack, -1, 1)) + 1e-6
    return -score + slack + 1e-6


@dataclass
class Rings:
    """Part number, pivot, distance range and rows of every ring that holds a row."""

    part: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray

    def apart(self, to_pivots: np.ndarray) -> np.ndarray:
        """(queries x rings) least distance of a row in the ring."""
        a = to_pivots[:, np.maximum(self.pivot, 0)]
        least = np.maximum(0, np.maximum(a - self.high, self.low - a))
        return np.where(self.part == ZERO, 0, least)

    def blocks(self, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """First block of every ring, and in how many blocks it lies.

        Neighbouring rings share a block; a ring with more than ``block_rows`` rows has several of its own.
        """
        split = np.maximum(1, -(-self.rows // block_rows))
        first, at, held = np.zeros(len(split), np.int64), 0, 0
        for i, (n, several) in enumerate(zip(self.rows.tolist(), split.tolist(), strict=True)):
            if held and (several > 1 or held + n > block_rows):
                at, held = at + 1, 0
            first[i] = at
            at, held = (at + several, 0) if several > 1 else (at, held + n)
        return first, split


def in_rings(vectors: DataFrame, pivots: np.ndarray, metric: str, id_col: str, vector_col: str) -> tuple[DataFrame, Rings]:
    """id, vector and ``cell`` (the part), stored, and what is known of the parts.

    The parts are at most the pivots times ``RINGS``, and one more.
    """
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(np.asarray(pivots, np.float64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column("vector"), centres.shape[1])
            far = _distances(matrix, centres, metric)
            pivot = far.argmin(axis=1)
            near = far[np.arange(len(far)), pivot]
            if metric == "cosine":
                lost = ~matrix.any(axis=1)
                pivot, near = np.where(lost, ZERO, pivot), np.where(lost, 0, near)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(pivot.astype(np.int32)), pa.array(near)],
                names=["id", "vector", "pivot", "far"],
            )

    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
    schema = T.StructType([*rows.schema.fields, T.StructField("pivot", T.IntegerType()), T.StructField("far", T.DoubleType())])
    placed = stage(spark, rows.mapInArrow(place, schema))
    ranges = placed.groupBy("pivot").agg(F.min("far").alias("lo"), F.max("far").alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("far") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0)
    ring = F.least(F.floor(width * RINGS), F.lit(RINGS - 1))
    ringed = placed.join(F.broadcast(ranges), "pivot").select(
        "id",
        "vector",
        F.when(F.col("pivot") == ZERO, ZERO).otherwise(F.col("pivot") * RINGS + ring).cast("int").alias("cell"),
        "pivot",
        "far",
    )
    known = (
        ringed.groupBy("cell", "pivot")
        .agg(F.min("far").alias("low"), F.max("far").alias("high"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    known.sort(key=lambda r: r["cell"])
    columns = [np.array([r[c] for r in known]) for c in ("cell", "pivot", "low", "high", "rows")]
    return ringed.select("id", "vector", "cell"), Rings(*columns)


def _chosen(matrix: np.ndarray, centres: np.ndarray, rings: Rings, k: int, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """(queries x rings) least distances, and a mask of the nearest rings that hold ``k`` rows together."""
    far = _distances(matrix, centres, metric)
    apart = rings.apart(far)
    # Of rings at equal distance the one with the nearer pivot comes first.
    order = np.lexsort((far[:, np.maximum(rings.pivot, 0)], apart), axis=1)
    held = np.cumsum(rings.rows[order], axis=1)
    nearest = np.empty(apart.shape, bool)
    np.put_along_axis(nearest, order, held - rings.rows[order] < k, axis=1)
    return apart, nearest


def _pieces(batches: Iterator[pa.RecordBatch], rings: Rings) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose (query x ring) numbers are few."""
    step = max(1, CHOSEN_AT_ONCE // max(1, len(rings.part)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _nearest_rings(queries: DataFrame, pivots: np.ndarray, rings: Rings, k: int, metric: str) -> DataFrame:
    """query_id, vector and ``cell``, one row per ring: the nearest ones that hold ``k`` rows together."""
    shared = queries.sparkSession.sparkContext.broadcast((np.asarray(pivots, np.float64), rings))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, rings = shared.value
        for batch in _pieces(batches, rings):
            matrix = _matrix(batch.column("vector"), centres.shape[1])
            query, ring = np.nonzero(_chosen(matrix, centres, rings, k, metric)[1])
            at = pa.array(query)
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id").take(at), batch.column("vector").take(at), pa.array(rings.part[ring].astype(np.int32))],
                names=["query_id", "vector", "cell"],
            )

    fields = [queries.schema["query_id"], queries.schema["vector"], T.StructField("cell", T.IntegerType())]
    return queries.mapInArrow(choose, T.StructType(fields))


def _other_rings(
    queries: DataFrame, pivots: np.ndarray, rings: Rings, k: int, metric: str, decimals: int, block_rows: int
) -> DataFrame:
    """query_id, vector, kth, ``block`` and ``cells``, one row per block to visit.

    ``cells`` are the rings of the block that were not among the nearest and may
    hold a row as good as ``kth``; without a ``kth`` all of them.
    """
    first, split = rings.blocks(block_rows)
    shared = queries.sparkSession.sparkContext.broadcast((np.asarray(pivots, np.float64), rings, first, split))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, rings, first, split = shared.value
        for batch in _pieces(batches, rings):
            matrix = _matrix(batch.column("vector"), centres.shape[1])
            apart, nearest = _chosen(matrix, centres, rings, k, metric)
            kth = batch.column("kth").to_numpy(zero_copy_only=False).astype(np.float64)
            reach = np.where(np.isnan(kth), np.inf, _reach(kth, metric, decimals))
            lost = (metric == "cosine") & ~matrix.any(axis=1)
            wanted = (apart <= reach[:, None]) | lost[:, None] | (rings.part == ZERO)
            query, ring = np.nonzero(wanted & ~nearest)
            # A ring in several blocks is visited in each; rings that share a block share a row.
            copies = split[ring]
            nth = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
            query, ring = np.repeat(query, copies), np.repeat(ring, copies)
            block = first[ring] + nth
            order = np.lexsort((ring, block, query))
            query, ring, block = query[order], ring[order], block[order]
            new = np.ones(len(query), bool)
            new[1:] = (query[1:] != query[:-1]) | (block[1:] != block[:-1])
            starts = np.flatnonzero(new)
            cells = pa.ListArray.from_arrays(
                pa.array(np.append(starts, len(query)).astype(np.int32)), pa.array(rings.part[ring].astype(np.int32))
            )
            at = pa.array(query[starts])
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(at) for c in ("query_id", "vector", "kth")],
                    pa.array(block[starts].astype(np.int32)),
                    cells,
                ],
                names=["query_id", "vector", "kth", "block", "cells"],
            )

    fields = [queries.schema[c] for c in ("query_id", "vector", "kth")]
    fields += [T.StructField("block", T.IntegerType()), T.StructField("cells", T.ArrayType(T.IntegerType()))]
    return queries.mapInArrow(choose, T.StructType(fields))


def _meet(rows: DataFrame, asked: DataFrame, rings: Rings, k: int, metric: str, decimals: int, block_rows: int) -> DataFrame:
    """The best ``k`` rows of each query in the rings that it asks for, at least as good as its ``kth``."""
    spark = rows.sparkSession
    first, split = (a.tolist() for a in rings.blocks(block_rows))
    # One row per ring, and one per block that a query visits: at most the rings and the pieces of large ones.
    places = spark.createDataFrame(list(zip(rings.part.tolist(), first, split, strict=True)), "cell int, first int, split int")
    parts = asked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts"))
    left = (
        rows.join(F.broadcast(places), "cell")
        .withColumn("block", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("split"))).cast("int"))
        .join(parts, "block")
        .select("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), "cell", "id", "vector")
    )
    right = asked.join(parts, "block").select(
        "block", F.pmod(F.xxhash64("query_id"), F.col("parts")).alias("part"), "query_id", "vector", "kth", "cells"
    )

    def score(vectors: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
        if vectors.empty or batch.empty:
            return pd.DataFrame({name: [] for name in ("query_id", "id", "score")})
        matrix = np.stack(batch["vector"].to_numpy()).astype(np.float64)
        best = _Best(matrix, k, metric, decimals, batch["kth"].to_numpy(np.float64))
        sizes = batch["cells"].map(len).to_numpy()
        query, cell = np.repeat(np.arange(len(batch)), sizes), np.concatenate(batch["cells"].to_numpy())
        order = np.argsort(cell, kind="stable")
        query, cell = query[order], cell[order]
        for number, part in vectors.groupby("cell"):
            only = query[np.searchsorted(cell, number) : np.searchsorted(cell, number, side="right")]
            ids, held = part["id"].to_numpy(np.int64), np.stack(part["vector"].to_numpy()).astype(np.float64)
            for start in range(0, len(part) if len(only) else 0, 2_000):
                best.add(ids[start : start + 2_000], held[start : start + 2_000], None, only)
        return pd.DataFrame(best.frame(batch["query_id"].to_numpy(np.int64)))

    keys = ["block", "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, _HIT)


@dataclass
class NearestJoin:
    """The hits of all queries, and which (query, part) meetings produced them."""

    hits: DataFrame
    probes: DataFrame
    rings: Rings

    def pairs_visited(self) -> int:
        """How many (query, row) pairs were scored."""
        sizes = dict(zip(self.rings.part.tolist(), self.rings.rows.tolist(), strict=True))
        counted = self.probes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()
        return sum(r["n"] * sizes[r["cell"]] for r in counted)


def nearest_join(
    vectors: DataFrame,
    queries: DataFrame,
    pivots: np.ndarray,
    k: int = TOP_K,
    metric: str = "cosine",
    id_col: str = "id",
    query_col: str = "query_id",
    vector_col: str = "vector",
    decimals: int = 6,
    block_rows: int = MEET_ROWS,
) -> NearestJoin:
    """`(query_id, rank, id, score)` of the ``k`` best rows of every query, however many there are.

    Equal to exact search: scores are rounded before ranking and ties go to the
    smaller id. Any pivots give the same result; good ones (see
    :func:`~tablework.operators.similarity.train_centroids`) leave fewer pairs.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError("only cosine and l2 have a triangle inequality")
    spark = vectors.sparkSession
    rows, rings = in_rings(vectors, pivots, metric, id_col, vector_col)
    asked = stage(spark, queries.select(F.col(query_col).cast("bigint").alias("query_id"), F.col(vector_col).alias("vector")))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    if not len(rings.part):
        empty = spark.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
        return NearestJoin(empty, spark.createDataFrame([], "query_id bigint, cell int"), rings)

    first = stage(spark, _nearest_rings(asked, pivots, rings, k, metric))
    near = stage(spark, first_per_group(_blocks(rows, first, k, metric, decimals), ["query_id"], [F.desc("score"), F.asc("id")], k))
    kth = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
    bounded = asked.join(kth.select("query_id", "kth"), "query_id", "left")
    second = stage(spark, _other_rings(bounded, pivots, rings, k, metric, decimals, block_rows))
    found = near.unionByName(_meet(rows, second, rings, k, metric, decimals, block_rows))
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    score = F.col("score") if metric != "l2" else -F.col("score")
    hits = ranked.select("query_id", "rank", "id", (score + F.lit(0.0)).alias("score"))
    # A ring that lies in several blocks was asked for in each.
    later = second.select("query_id", F.explode("cells").alias("cell")).distinct()
    both = first.select("query_id", "cell").unionByName(later)
    return NearestJoin(hits, both, rings)
