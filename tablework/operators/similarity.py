"""Nearest-neighbour search over vector columns, exact and by cells.

Scores are computed in Arrow batches: a task keeps the best ``k`` rows per
query while it streams over its vectors and emits only those, so the shuffle
carries ``queries x k`` rows per task instead of every pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.runtime import SMALL_ROWS, broadcast_if_small

# Cells, probed cells, hits, key length and metrics.
NLIST = 128
NPROBE = 10
TOP_K = 5
MAX_KEY_LENGTH = 100
METRICS = ("cosine", "l2", "ip")

#: Centroids of up to this many floats are shipped with every task (64 MB as double).
SMALL_FLOATS = 8_000_000
#: Vectors and queries that meet in one task when the batch is larger.
BLOCK_ROWS = 20_000
#: Hits that a task holds before it cuts them to the best of each query; ties can be many.
HELD_HITS = 2_000_000

_HIT = "query_id bigint, id bigint, score double"


def parse_vectors(text: Column | str) -> Column:
    """Vectors that were stored as JSON list text."""
    return F.from_json(F.col(text) if isinstance(text, str) else text, "array<float>")


def vector_checks(
    vectors: DataFrame, dim: int, id_col: str = "id", key_col: str = "order_id", vector_col: str = "vector"
) -> DataFrame:
    """One row of counts: wrong widths, repeated ids, overlong keys."""
    per_id = vectors.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(F.size(vector_col) != dim, F.lit(True))).alias("wrong"),
        F.max(F.length(key_col)).alias("longest"),
    )
    return per_id.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_vectors"),
        F.coalesce(F.sum("wrong"), F.lit(0)).alias("wrong_dim"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_ids"),
        F.coalesce(F.max("longest"), F.lit(0)).alias("max_key_length"),
    )


def require_collection(vectors: DataFrame, dim: int, max_key: int = MAX_KEY_LENGTH, **columns: str) -> int:
    """Fail with counts when the rows do not fit a collection, else return their number."""
    found = vector_checks(vectors, dim, **columns).first()
    if found["wrong_dim"] or found["duplicate_ids"] or found["max_key_length"] > max_key:
        raise ValueError(f"rows do not fit the collection: {found.asDict()}")
    return found["n_vectors"]


@dataclass
class Queries:
    """A query batch: held as a matrix when its size is proven small."""

    frame: DataFrame
    ids: np.ndarray | None
    matrix: np.ndarray | None

    @property
    def small(self) -> bool:
        return self.ids is not None

    @classmethod
    def of(
        cls, df: DataFrame, id_col: str, vector_col: str, max_rows: int = SMALL_ROWS
    ) -> Queries:
        frame = df.select(F.col(id_col).cast("bigint").alias("query_id"), F.col(vector_col).alias("vector"))
        rows = frame.limit(max_rows + 1).toArrow().combine_chunks()
        if rows.num_rows > max_rows:
            return cls(frame, None, None)
        if not rows.num_rows:
            return cls(frame, np.empty(0, np.int64), np.empty((0, 0)))
        vectors = rows.column("vector").combine_chunks()
        width = len(vectors[0]) if vectors[0].is_valid else -1
        ids = np.asarray(rows.column("query_id"), dtype=np.int64)
        matrix = _matrix(vectors, width)
        return cls(frame, ids, matrix)


def search(
    vectors: DataFrame,
    queries: Queries,
    k: int = TOP_K,
    metric: str = "cosine",
    id_col: str = "id",
    vector_col: str = "vector",
    decimals: int = 6,
    key_col: str | None = None,
) -> DataFrame:
    """Exact search: `(query_id, rank, id, score)` of the ``k`` best per query.

    Scores are rounded before ranking and ties go to the smaller id, so results
    do not depend on partitioning. With ``key_col`` the hits also carry that
    column of their rows, as text, without a second scan.
    """
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).alias("vector"),
        F.lit(0).alias("cell"),
        *_keyed(key_col),
    )
    probes = None if queries.small else queries.frame.withColumn("cell", F.lit(0))
    everywhere = np.ones((1, len(queries.ids)), dtype=bool) if queries.small else None
    return _best(rows, queries, everywhere, probes, k, metric, decimals)


def train_centroids(
    vectors: DataFrame, nlist: int = NLIST, vector_col: str = "vector", seed: int = 42
) -> np.ndarray:
    """Cell centres by distributed k-means under cosine distance over all rows with a vector.

    Zero vectors have no direction and take no part.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = vectors.where(F.exists(vector_col, lambda x: x != 0))
    features = rows.select(
        array_to_vector(F.col(vector_col).cast("array<double>")).alias("features")
    )
    model = KMeans(k=max(1, min(nlist, rows.count())), distanceMeasure="cosine", seed=seed).fit(features)
    return np.array(model.clusterCenters())


def assign_cells(
    vectors: DataFrame,
    centroids: np.ndarray,
    vector_col: str = "vector",
    decimals: int = 6,
    floats_at_once: int = SMALL_FLOATS,
) -> DataFrame:
    """Add ``cell``: the centre with the highest cosine, the first one on a tie.

    Centres are shipped in blocks of ``floats_at_once`` numbers; with several
    blocks the best of each is compared. A missing vector has no cell.
    """
    centres = _unit(np.asarray(centroids, dtype=np.float64))
    step = max(1, floats_at_once // max(1, centres.shape[1]))
    best = [_nearest_centre(centres[at : at + step], at, decimals)(vector_col) for at in range(0, len(centres), step)]
    if len(best) == 1:
        return vectors.withColumn("cell", best[0]["cell"])
    # The larger score wins, then the smaller number: negated, one maximum decides.
    return vectors.withColumn("cell", (-F.greatest(*best)["order"]).cast("int"))


def _nearest_centre(centres: np.ndarray, first: int, decimals: int):
    @F.pandas_udf("struct<score: double, order: int, cell: int>")
    def nearest(batch: pd.Series) -> pd.DataFrame:
        there = batch.notna().to_numpy()
        score, cell = np.full(len(batch), np.nan), np.zeros(len(batch), np.int64)
        if there.any():
            scores = np.round(_unit(np.stack(batch[there].to_numpy()).astype(np.float64)) @ centres.T, decimals)
            cell[there] = np.argmax(scores, axis=1)
            score[there] = scores[np.arange(len(scores)), cell[there]]
        cells = pd.Series(cell + first, dtype="Int32").where(there)
        return pd.DataFrame({"score": pd.Series(score).where(there), "order": -cells, "cell": cells})

    return nearest


def search_cells(
    indexed: DataFrame,
    queries: Queries,
    centroids: np.ndarray,
    k: int = TOP_K,
    nprobe: int = NPROBE,
    metric: str = "cosine",
    id_col: str = "id",
    vector_col: str = "vector",
    decimals: int = 6,
    key_col: str | None = None,
) -> DataFrame:
    """Search the ``nprobe`` nearest cells of each query.

    With all cells probed the result equals exact search. For a small batch the
    probed cells become a literal filter on ``cell``, which prunes partitions.
    """
    centres = _unit(np.asarray(centroids, dtype=np.float64))
    nprobe = min(nprobe, len(centres))
    rows = indexed.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"), "cell", *_keyed(key_col)
    )
    if queries.small and not len(queries.ids):
        return _best(rows, queries, None, None, k, metric, decimals)
    if queries.small:
        probed = _probed(queries.matrix, centres, nprobe, decimals)
        cells = [int(c) for c in np.flatnonzero(probed.any(axis=1))]
        return _best(rows.where(F.col("cell").isin(cells)), queries, probed, None, k, metric, decimals)

    @F.pandas_udf("array<int>")
    def nearest(batch: pd.Series) -> pd.Series:
        matrix = np.stack(batch.to_numpy()).astype(np.float64)
        hit = _probed(matrix, centres, nprobe, decimals).T
        return pd.Series([np.flatnonzero(row).astype(np.int32) for row in hit])

    probes = queries.frame.withColumn("cell", F.explode(nearest("vector")))
    return _best(rows, queries, None, probes, k, metric, decimals)


def _keyed(key_col: str | None) -> list[Column]:
    return [] if key_col is None else [F.col(key_col).cast("string").alias("key")]


def fetch_hits(
    hits: DataFrame, rows: DataFrame, hit_key: str, row_key: str, max_hits: int | None = None
) -> DataFrame:
    """Full rows of the hits, with rank and score kept.

    ``max_hits`` is a proven bound on the number of hits (queries times k);
    within it the hits are broadcast and ``rows`` is only scanned.
    """
    side = F.broadcast(hits) if max_hits is not None and max_hits <= SMALL_ROWS * 10 else hits
    return rows.join(side, F.col(row_key) == F.col(hit_key))


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1, norms)


def _probed(queries: np.ndarray, centres: np.ndarray, nprobe: int, decimals: int) -> np.ndarray:
    """(cells x queries) mask of the cells each query looks into."""
    score = np.round(_unit(queries) @ centres.T, decimals)
    nearest = np.argsort(-score, axis=1, kind="stable")[:, :nprobe]
    mask = np.zeros((len(centres), len(queries)), dtype=bool)
    mask[nearest.ravel(), np.repeat(np.arange(len(queries)), nprobe)] = True
    return mask


def _closeness(vectors: np.ndarray, queries: np.ndarray, metric: str, decimals: int) -> np.ndarray:
    """(vectors x queries) rounded scores; larger is nearer, so distances are negated."""
    if metric == "cosine":
        score = _unit(vectors) @ _unit(queries).T
    elif metric == "ip":
        score = vectors @ queries.T
    else:
        # Differences, not the expanded square: that cancels for close vectors.
        score = -np.stack([np.linalg.norm(vectors - q, axis=1) for q in queries], axis=1)
    return np.round(score, decimals)


def _within(vectors: np.ndarray, queries: np.ndarray, floor: np.ndarray, decimals: int) -> tuple[np.ndarray, ...]:
    """Rows, queries and rounded negative distances of the pairs with a score of at least ``floor``.

    Expanded squares with their rounding error taken off drop pairs that are too
    far; the distance of the others comes from differences.
    """
    of_rows, of_queries = (np.einsum("ij,ij->i", m, m) for m in (vectors, queries))
    reach = np.maximum(-floor, 0) + 10.0**-decimals
    error = 1e-15 * (8 + vectors.shape[1]) * (of_rows.max(initial=0) + of_queries)
    least = of_rows[:, None] + of_queries - 2 * (vectors @ queries.T)
    row, query = np.nonzero(least <= reach * reach * (1 + 1e-12) + 4 * error)
    parts = [
        np.linalg.norm(vectors[row[at : at + 100_000]] - queries[query[at : at + 100_000]], axis=1)
        for at in range(0, len(row), 100_000)
    ]
    score = -np.round(np.concatenate([np.empty(0), *parts]), decimals)
    good = score >= floor[query]
    return row[good], query[good], score[good]


class _Best:
    """The best k rows per query seen so far in one task."""

    def __init__(self, queries: np.ndarray, k: int, metric: str, decimals: int, floor: np.ndarray | None = None):
        """``floor`` has scores that hits must reach, NaN where there is no such score."""
        self.queries, self.k, self.metric, self.decimals = queries, k, metric, decimals
        self.floor = np.full(len(queries), -np.inf) if floor is None else np.where(np.isnan(floor), -np.inf, floor)
        self.query = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.score = np.empty(0)

    def add(self, ids: np.ndarray, vectors: np.ndarray, allowed: np.ndarray | None, only: np.ndarray | None = None) -> None:
        """Score a batch; ``allowed`` masks the (vector, query) pairs, ``only`` has the numbers of the queries to consider."""
        step = max(1, 4_000_000 // max(1, len(ids)))
        for start in range(0, len(self.queries) if only is None else len(only), step):
            part = slice(start, start + step) if only is None else only[start : start + step]
            bounded = np.isfinite(self.floor[part]).all()
            if bounded and allowed is None and self.metric == "l2":
                row, query, score = _within(vectors, self.queries[part], self.floor[part], self.decimals)
            else:
                scores = _closeness(vectors, self.queries[part], self.metric, self.decimals)
                if allowed is not None:
                    scores[~allowed[:, part]] = -np.inf
                if len(ids) > self.k and not bounded:
                    kth = np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k]
                    self.floor[part] = np.maximum(self.floor[part], kth)
                row, query = np.nonzero((scores >= self.floor[part]) & np.isfinite(scores))
                score = scores[row, query]
            self.query = np.concatenate([self.query, query + start if only is None else part[query]])
            self.id = np.concatenate([self.id, ids[row]])
            self.score = np.concatenate([self.score, score])
            if len(self.query) > HELD_HITS + self.k * len(self.queries):
                self._cut()
        self._cut()

    def _cut(self) -> None:
        order = np.lexsort((self.id, -self.score, self.query))
        query = self.query[order]
        first = np.searchsorted(query, query, side="left")
        place = np.arange(len(query)) - first
        kept = order[place < self.k]
        last = place == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], self.score[order][last])
        self.query, self.id, self.score = self.query[kept], self.id[kept], self.score[kept]

    def frame(self, query_ids: np.ndarray) -> dict[str, np.ndarray]:
        return {"query_id": query_ids[self.query], "id": self.id, "score": self.score}


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """List column to a matrix without a Python object per row."""
    if column.null_count or not pc.all(pc.equal(pc.list_value_length(column), width)).as_py():
        raise ValueError(f"vector is missing or not of width {width}")
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), width)


def _best(
    rows: DataFrame,
    queries: Queries,
    probed: np.ndarray | None,
    probes: DataFrame | None,
    k: int,
    metric: str,
    decimals: int,
) -> DataFrame:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    keyed = "key" in rows.columns
    if queries.small and not len(queries.ids):
        partial = rows.sparkSession.createDataFrame([], _hit(keyed))
    elif queries.small:
        partial = _scan(rows, queries, probed, k, metric, decimals)
    else:
        partial = _blocks(rows, probes, k, metric, decimals)
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = partial.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    score = F.col("score") if metric != "l2" else -F.col("score")
    # Adding zero turns a negative zero into a plain one.
    return ranked.select("query_id", "rank", "id", (score + F.lit(0.0)).alias("score"), *(["key"] if keyed else []))


def _hit(keyed: bool) -> str:
    return f"{_HIT}, key string" if keyed else _HIT


class _Keys:
    """The keys of the rows that a task holds as its best."""

    def __init__(self):
        self.of: dict[int, str | None] = {}

    def see(self, ids: np.ndarray, keys: pa.Array, held: np.ndarray) -> None:
        at = np.flatnonzero(np.isin(ids, held))
        self.of.update(zip(ids[at].tolist(), keys.take(pa.array(at)).to_pylist(), strict=True))
        if len(self.of) > 1_000 + 4 * len(held):
            wanted = set(held.tolist())
            self.of = {i: k for i, k in self.of.items() if i in wanted}

    def column(self, ids: np.ndarray) -> list[str | None]:
        return [self.of[i] for i in ids.tolist()]


def _scan(
    rows: DataFrame, queries: Queries, probed: np.ndarray, k: int, metric: str, decimals: int
) -> DataFrame:
    """Stream over the vectors with the broadcast batch; no shuffle of vectors."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((queries.ids, queries.matrix, probed))
    keyed = "key" in rows.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, mask = shared.value
        best, keys = _Best(matrix, k, metric, decimals), _Keys()
        for batch in batches:
            if batch.num_rows == 0 or len(ids) == 0:
                continue
            allowed = None if mask.all() else mask[np.asarray(batch.column("cell"))]
            row_ids = np.asarray(batch.column("id"), dtype=np.int64)
            best.add(row_ids, _matrix(batch.column("vector"), matrix.shape[1]), allowed)
            if keyed:
                keys.see(row_ids, batch.column("key"), best.id)
        found = best.frame(ids)
        if keyed:
            found["key"] = pa.array(keys.column(best.id), pa.string())
        yield pa.RecordBatch.from_pydict(found)

    return rows.mapInArrow(scan, _hit(keyed))


def _blocks(rows: DataFrame, probes: DataFrame, k: int, metric: str, decimals: int) -> DataFrame:
    """Larger batches: blocks of vectors meet blocks of queries of their cell.

    Both sides are hashed into blocks of about ``BLOCK_ROWS`` within a cell, so
    neither a full cell nor the whole batch reaches one task.
    """
    keyed = "key" in rows.columns
    v_counts = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("v_blocks"))
    q_counts = probes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("q_blocks"))
    # One row per cell, of which there are at most nlist.
    counts = broadcast_if_small(v_counts.join(q_counts, "cell"), SMALL_ROWS)

    def numbers(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    left = rows.join(counts, "cell").select(
        "cell",
        F.pmod(F.xxhash64("id"), F.col("v_blocks")).alias("v"),
        numbers("q_blocks").alias("q"),
        "id",
        "vector",
        *(["key"] if keyed else []),
    )
    right = probes.join(counts, "cell").select(
        "cell",
        numbers("v_blocks").alias("v"),
        F.pmod(F.xxhash64("query_id"), F.col("q_blocks")).alias("q"),
        "query_id",
        "vector",
    )

    def score(vectors: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
        if vectors.empty or batch.empty:
            return pd.DataFrame({name: [] for name in ("query_id", "id", "score", *(["key"] if keyed else []))})
        matrix = np.stack(batch["vector"].to_numpy()).astype(np.float64)
        best = _Best(matrix, k, metric, decimals)
        for start in range(0, len(vectors), 2_000):
            part = vectors.iloc[start : start + 2_000]
            best.add(
                part["id"].to_numpy(np.int64), np.stack(part["vector"].to_numpy()).astype(np.float64), None
            )
        found = pd.DataFrame(best.frame(batch["query_id"].to_numpy(np.int64)))
        if keyed:
            of = dict(zip(vectors["id"].tolist(), vectors["key"].tolist(), strict=True))
            found["key"] = [of[i] for i in found["id"].tolist()]
        return found

    keys = ["cell", "v", "q"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, _hit(keyed))
