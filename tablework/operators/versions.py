"""Change batches that carry a commit number and time: history and as-of reads.

Batches are appended to an ordinary table; a row's ``commit_id`` and
``committed_at`` say when it came. The table at a version is the newest row of
every key up to it, so any table that holds such rows can be read as of a
version. Reads are declared by a schema: a column added by a later batch is NULL
in earlier rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.times import run_time
from tablework.operators.upsert import newest_per_key

STAMPS = [T.StructField("committed_at", T.TimestampNTZType()), T.StructField("commit_id", T.LongType())]


def stamped(batch: DataFrame, commit_id: int, committed_at: Column | str | None = None) -> DataFrame:
    """A batch (one row per key) with its commit number and time."""
    return batch.withColumns(
        {
            "committed_at": run_time(committed_at).cast("timestamp_ntz"),
            "commit_id": F.lit(commit_id).cast("long"),
        }
    )


def append_batch(
    batch: DataFrame, path: str, commit_id: int, committed_at: Column | str | None = None
) -> None:
    """Write a batch beside the others; writing the same number again replaces it."""
    (
        stamped(batch, commit_id, committed_at)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("commit_id")
        .parquet(path)
    )


def read_changes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches under the declared columns."""
    return spark.read.schema(T.StructType([*schema.fields, *STAMPS])).parquet(path)


def history(changes: DataFrame, keys: list[str], last: int | None = None) -> DataFrame:
    """Commits, newest first; one that touches known keys is an overwrite. Reads keys and stamps only."""
    first = F.min("commit_id").over(Window.partitionBy(*keys))
    commits = (
        changes.select(*keys, "commit_id", "committed_at")
        .withColumn("known", F.col("commit_id") > first)
        .groupBy("commit_id", "committed_at")
        .agg(
            F.when(F.bool_or("known"), "overwrite").otherwise("append").alias("operation"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )
    ordered = commits.orderBy(F.desc("committed_at"), F.desc("commit_id"))
    return ordered.limit(last) if last else ordered


def as_of(
    changes: DataFrame, keys: list[str], version: int | None = None, at: Column | str | None = None
) -> DataFrame:
    """The table as it was at a commit, at a time, or at both; the latest by default.

    Without any commit up to there the result is empty. Commit numbers prune
    partitions of a table written by :func:`append_batch`.
    """
    rows = changes
    if version is not None:
        rows = rows.where(F.col("commit_id") <= version)
    if at is not None:
        rows = rows.where(F.col("committed_at") <= run_time(at).cast("timestamp_ntz"))
    return newest_per_key(rows, keys, [F.desc("commit_id")]).drop("commit_id", "committed_at")
