"""A stored collection of vectors: centres, vectors by cell, and counts per batch.

Centres are chosen when the collection is made and stored beside the vectors.
A batch is checked, matched against the stored ids (a scan of that one column),
assigned to the stored centres and appended to its cells. Every file lies below
the cell and the number of its batch, and so does a row of counts, so the number
of entities is a sum over counts and a batch that is inserted again after a
failure replaces itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.operators.numbering import first_per_group
from tablework.operators.publish import stage
from tablework.operators.similarity import MAX_KEY_LENGTH, assign_cells
from tablework.schemas import VECTORS
from tablework.sinks.layout import laid_out

_STORED = T.StructType(
    [*VECTORS.fields, T.StructField("cell", T.IntegerType()), T.StructField("batch", T.LongType())]
)
_COUNTS = "cell int, n bigint, batch bigint"
_CENTRES = "cell int, centre array<double>"


def _below(path: str, part: str) -> str:
    return f"{path.rstrip('/')}/{part}"


def create_collection(spark: SparkSession, path: str, centroids: np.ndarray) -> None:
    """An empty collection with the centres of its cells."""
    centres = [(i, [float(x) for x in row]) for i, row in enumerate(np.asarray(centroids))]
    spark.createDataFrame(centres, _CENTRES).coalesce(1).write.mode("errorifexists").parquet(_below(path, "centres"))
    for part, schema in (("cells", _STORED), ("counts", _COUNTS)):
        spark.createDataFrame([], schema).write.mode("errorifexists").parquet(_below(path, part))


def stored_centres(spark: SparkSession, path: str) -> np.ndarray:
    """The centres of a collection, as many as its creator chose."""
    rows = spark.read.schema(_CENTRES).parquet(_below(path, "centres")).collect()
    return np.array([r["centre"] for r in sorted(rows, key=lambda r: r["cell"])])


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """All vectors with their cell and batch, both stored as partitions."""
    return spark.read.schema(_STORED).parquet(_below(path, "cells"))


def cell_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per cell and batch, as they were counted when they were inserted."""
    return spark.read.schema(_COUNTS).parquet(_below(path, "counts"))


def entity_count(spark: SparkSession, path: str) -> int:
    return cell_counts(spark, path).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _unfit(dim: int, max_key: int) -> Column:
    fits = F.col("id").isNotNull() & (F.size("vector") == dim) & ~F.exists("vector", lambda x: x.isNull())
    return ~F.coalesce(fits & (F.coalesce(F.length("order_id"), F.lit(0)) <= max_key), F.lit(False))


def insert_batch(
    spark: SparkSession, path: str, batch: DataFrame, number: int, dim: int, max_key: int = MAX_KEY_LENGTH
) -> dict[str, int]:
    """Insert the rows of ``batch`` that fit and are new; returns how many rows met which end.

    A row is ``unfit`` without an id, with a vector of another width or with
    missing numbers, or with an overlong key. It is ``known`` when an earlier
    batch holds its id, and ``repeated`` when the batch itself has a row with
    that id and a smaller key (then vector). The rest is ``inserted``.
    """
    rows = stage(spark, batch.select(*VECTORS.fieldNames()))
    # Ids only: other columns of the stored vectors aren't read.
    stored = read_collection(spark, path).where(F.col("batch") != number).select(F.col("id").alias("__stored"))
    marked = rows.withColumn("__unfit", _unfit(dim, max_key))
    fitting = marked.where(~F.col("__unfit")).drop("__unfit")
    fresh = fitting.join(stored, F.col("id") == F.col("__stored"), "left_anti")
    single = first_per_group(fresh, ["id"], [F.asc("order_id"), F.asc("vector")])
    centres = stored_centres(spark, path)
    placed = stage(spark, assign_cells(single.select(*VECTORS.fieldNames()), centres))

    facts = marked.agg(F.count(F.lit(1)).alias("offered"), F.count_if("__unfit").alias("unfit")).first()
    new = fresh.count()
    per_cell = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).withColumn("batch", F.lit(number).cast("bigint"))
    inserted = placed.count()

    (
        laid_out(placed, "cell", ["id"])
        .withColumn("batch", F.lit(number).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("cell", "batch")
        .parquet(_below(path, "cells"))
    )
    (
        per_cell.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(_below(path, "counts"))
    )
    return {
        "offered": facts["offered"],
        "inserted": inserted,
        "known": facts["offered"] - facts["unfit"] - new,
        "repeated": new - inserted,
        "unfit": facts["unfit"],
    }
