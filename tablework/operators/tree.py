"""Two-level vector cells: coarse centres, fine centres inside each, and further splits.

The tree is grown by distributed k-means: first the coarse cells of all vectors,
then the fine ones of each coarse cell, and again inside any cell that holds more
than ``max_rows``, so no cell is hot. A vector descends to the nearest child at
every node and thus meets only centres below its own coarse one; probing goes
down the same tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.operators.publish import stage
from tablework.operators.similarity import METRICS, TOP_K, Queries, _best, _matrix, _unit, train_centroids

#: Coarse cells, fine cells inside each, and rows beyond which a cell is split again.
COARSE, FINE, MAX_ROWS = 16, 8, 1_000_000
#: A cell of equal vectors can't be split; the tree grows no deeper than this.
MOST_LEVELS = 6


@dataclass
class CellTree:
    """Nodes in the order of their making; ``children`` and ``centres`` of the inner ones, ``leaf`` numbers of the rest."""

    children: dict[int, list[int]] = field(default_factory=dict)
    centres: dict[int, np.ndarray] = field(default_factory=dict)
    leaf: dict[int, int] = field(default_factory=dict)

    @property
    def leaves(self) -> int:
        return len(self.leaf)

    def place(self, matrix: np.ndarray, decimals: int) -> tuple[np.ndarray, np.ndarray]:
        """Node and leaf of each vector; of equally near children the first."""
        node = np.zeros(len(matrix), np.int64)
        unit = _unit(matrix)
        todo = [0]
        while todo:
            at = todo.pop()
            if at not in self.children:
                continue
            mine = np.flatnonzero(node == at)
            if len(mine):
                score = np.round(unit[mine] @ self.centres[at].T, decimals)
                node[mine] = np.array(self.children[at])[score.argmax(axis=1)]
            todo += self.children[at]
        return node, np.array([self.leaf[n] for n in node.tolist()], np.int64)

    def probed(self, queries: np.ndarray, nprobe: int, decimals: int) -> np.ndarray:
        """(leaves x queries) mask of the ``nprobe`` leaves that each query reaches first, nearest child first.

        A leaf's rank is the score of its own centre; a node is opened when its
        score is among the best that are left.
        """
        mask = np.zeros((self.leaves, len(queries)), bool)
        unit = _unit(queries)
        scores = {at: np.round(unit @ centres.T, decimals) for at, centres in self.centres.items()}
        for q in range(len(queries)):
            open_nodes, taken = [(0.0, 0)], 0
            while open_nodes and taken < nprobe:
                best = min(range(len(open_nodes)), key=lambda i: (-open_nodes[i][0], open_nodes[i][1]))
                at = open_nodes.pop(best)[1]
                if at in self.leaf:
                    mask[self.leaf[at], q] = True
                    taken += 1
                    continue
                open_nodes += [(float(s), c) for s, c in zip(scores[at][q], self.children[at], strict=True)]
        return mask


def _descend(vectors: DataFrame, tree: CellTree, vector_col: str, decimals: int, column: str, leaves: bool) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            there = batch.column(vector_col).is_valid().to_numpy(zero_copy_only=False)
            cell = np.full(batch.num_rows, -1, np.int64)
            if there.any():
                held = batch.column(vector_col).filter(pa.array(there))
                width = len(held[0])
                cell[there] = tree.place(_matrix(held, width), decimals)[1 if leaves else 0]
            # A missing vector has no cell.
            cells = pa.array(cell.astype(np.int32), mask=~there)
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[*batch.schema.names, column])

    schema = T.StructType([*vectors.schema.fields, T.StructField(column, T.IntegerType())])
    return vectors.mapInArrow(place, schema)


def train_tree(
    vectors: DataFrame,
    coarse: int = COARSE,
    fine: int = FINE,
    max_rows: int = MAX_ROWS,
    vector_col: str = "vector",
    decimals: int = 6,
    seed: int = 42,
) -> CellTree:
    """Grow the tree over all rows with a vector.

    One k-means per node that is split; the rows of a node are read from a table
    that is stored by node, level by level.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(vector_col).isNotNull()).select(vector_col)
    tree, fresh = CellTree(), 1
    pending = [0]
    for level in range(MOST_LEVELS):
        placed = _descend(rows, _numbered(tree), vector_col, decimals, "node", leaves=False) if level else rows.withColumn("node", F.lit(0))
        stored = stage(spark, placed)
        sizes = {r["node"]: r["n"] for r in stored.groupBy("node").agg(F.count(F.lit(1)).alias("n")).collect()}
        split = []
        for node in pending:
            n = sizes.get(node, 0)
            parts = coarse if level == 0 else fine if level == 1 else -(-n // max_rows) if n > max_rows else 1
            if n < 2 or parts < 2:
                continue
            centres = train_centroids(stored.where(F.col("node") == node), parts, vector_col, seed)
            if len(centres) < 2:
                continue
            tree.centres[node] = _unit(centres)
            tree.children[node] = list(range(fresh, fresh + len(centres)))
            split += tree.children[node]
            fresh += len(centres)
        pending = split
        if not pending:
            break
    return _numbered(tree)


def _numbered(tree: CellTree) -> CellTree:
    """The tree with its leaves numbered from 0, parents before children."""
    inner = set(tree.children)
    nodes = {0} | {c for children in tree.children.values() for c in children}
    leaf = {node: i for i, node in enumerate(sorted(nodes - inner))}
    return CellTree(tree.children, tree.centres, leaf)


def assign_tree(vectors: DataFrame, tree: CellTree, vector_col: str = "vector", decimals: int = 6) -> DataFrame:
    """Add ``cell``: the leaf that the vector descends to; a missing vector has none."""
    return _descend(vectors, tree, vector_col, decimals, "cell", leaves=True)


def search_tree(
    indexed: DataFrame,
    queries: Queries,
    tree: CellTree,
    nprobe: int,
    k: int = TOP_K,
    metric: str = "cosine",
    id_col: str = "id",
    vector_col: str = "vector",
    decimals: int = 6,
) -> DataFrame:
    """Search the ``nprobe`` leaves that each query reaches first; all leaves give exact search."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    rows = indexed.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"), "cell")
    if queries.small and not len(queries.ids):
        return _best(rows, queries, None, None, k, metric, decimals)
    if queries.small:
        probed = tree.probed(queries.matrix, nprobe, decimals)
        cells = [int(c) for c in np.flatnonzero(probed.any(axis=1))]
        return _best(rows.where(F.col("cell").isin(cells)), queries, probed, None, k, metric, decimals)
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                held = batch.column("vector")
                mask = shared.value.probed(_matrix(held, len(held[0])), nprobe, decimals)
                query, cell = np.nonzero(mask.T)
                at = pa.array(query)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id").take(at), held.take(at), pa.array(cell.astype(np.int32))],
                    names=["query_id", "vector", "cell"],
                )

    fields = [*queries.frame.schema.fields, T.StructField("cell", T.IntegerType())]
    probes = queries.frame.mapInArrow(choose, T.StructType(fields))
    return _best(rows, queries, None, probes, k, metric, decimals)
