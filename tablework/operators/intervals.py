"""Tables whose rows carry the commits between which they were valid.

Open versions lie in ``current`` by a bucket of the key, closed ones in
``closed`` by the commit that closed them and the bucket. A merge closes the
versions it replaces inside the buckets that its batch touches and writes those
buckets of the base anew; other buckets stay as they are. The table as of a
commit is then a range filter over both parts: nothing is grouped or sorted, and
versions closed before that commit are pruned with their partitions.

Commits are numbered and timed in ascending order. A merge that stopped half-way
is run again with the same number: closed versions are written before their
buckets, and rows of the same commit are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.times import run_time
from tablework.operators.publish import stage
from tablework.operators.upsert import newest_per_key

#: Buckets of a table; a merge rewrites the ones its keys fall into.
BUCKETS = 64

_OPEN = [T.StructField("valid_from", T.LongType()), T.StructField("from_time", T.TimestampNTZType())]
_ENDED = [*_OPEN, T.StructField("to_time", T.TimestampNTZType())]
_BUCKET, _CLOSED_IN = T.StructField("bucket", T.IntegerType()), T.StructField("closed_in", T.LongType())
_COMMITS = "commit_id bigint, committed_at timestamp_ntz"


def _part(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def create_versions(spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS) -> None:
    """An empty table with a fixed number of buckets."""
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("errorifexists").parquet(_part(path, "layout"))
    parts = {
        "current": T.StructType([*schema.fields, *_OPEN, _BUCKET]),
        "closed": T.StructType([*schema.fields, *_ENDED, _CLOSED_IN, _BUCKET]),
        "commits": _COMMITS,
    }
    for name, fields in parts.items():
        spark.createDataFrame([], fields).write.mode("errorifexists").parquet(_part(path, name))


def open_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version of every row; columns that older files lack are NULL."""
    return spark.read.schema(T.StructType([*schema.fields, *_OPEN, _BUCKET])).parquet(_part(path, "current"))


def closed_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Replaced versions; ``closed_in`` is the commit that replaced them."""
    fields = [*schema.fields, *_ENDED, _CLOSED_IN, _BUCKET]
    return spark.read.schema(T.StructType(fields)).parquet(_part(path, "closed"))


def commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_COMMITS).parquet(_part(path, "commits"))


def merge_commit(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    commit_id: int,
    committed_at: Column | str | None = None,
    newest_first: list[Column] | None = None,
) -> list[int]:
    """Merge a batch as commit ``commit_id``; returns the buckets that were written.

    A NULL key fails the job. Of several rows with one key the first by
    ``newest_first`` counts; without an order keys must be unique.
    """
    last = commits(spark, path).where(F.col("commit_id") >= commit_id).agg(F.max("commit_id")).first()[0]
    if last is not None and last > commit_id:
        raise ValueError(f"commit {commit_id} comes after commit {last}")
    schema = batch.schema
    buckets = spark.read.parquet(_part(path, "layout")).first()[0]
    for key in keys:
        checked = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"merge: NULL {key}")))
        batch = batch.withColumn(key, checked.otherwise(F.col(key)))
    if newest_first:
        batch = newest_per_key(batch, keys, newest_first)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    now = run_time(committed_at).cast("timestamp_ntz")
    fresh = stage(
        spark,
        batch.withColumns({"valid_from": F.lit(commit_id).cast("long"), "from_time": now, "bucket": bucket}),
    )
    # At most as many values as the table has buckets.
    touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
    if touched:
        older = open_versions(spark, path, schema).where(F.col("bucket").isin(touched) & (F.col("valid_from") < commit_id))
        known = fresh.select("bucket", *keys)
        replaced = older.join(known, ["bucket", *keys], "left_semi")
        columns = [*schema.fieldNames(), "valid_from", "from_time"]
        (
            replaced.select(*columns, now.alias("to_time"), F.lit(commit_id).cast("long").alias("closed_in"), "bucket")
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("closed_in", "bucket")
            .parquet(_part(path, "closed"))
        )
        kept = older.join(known, ["bucket", *keys], "left_anti").select(*columns, "bucket")
        (
            kept.unionByName(fresh.select(*columns, "bucket"))
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(_part(path, "current"))
        )
    done = commits(spark, path).where(F.col("commit_id") == commit_id)
    if done.isEmpty():
        row = spark.range(1).select(F.lit(commit_id).cast("long").alias("commit_id"), now.alias("committed_at"))
        row.coalesce(1).write.mode("append").parquet(_part(path, "commits"))
    return touched


def valid_at(
    spark: SparkSession, path: str, schema: T.StructType, version: int | None = None, at: Column | str | None = None
) -> DataFrame:
    """The table at a commit, at a time, or at both; the latest by default.

    Two scans and a range filter each; a commit prunes the partitions of
    versions that were closed up to it.
    """
    now, ended = open_versions(spark, path, schema), closed_versions(spark, path, schema)
    if version is None and at is None:
        return now.select(*schema.fieldNames())
    began, still = F.lit(True), F.lit(False)
    if version is not None:
        began, still = began & (F.col("valid_from") <= version), still | (F.col("closed_in") > version)
    if at is not None:
        moment = run_time(at).cast("timestamp_ntz")
        began, still = began & (F.col("from_time") <= moment), still | (F.col("to_time") > moment)
    return now.where(began).select(*schema.fieldNames()).unionByName(
        ended.where(began & still).select(*schema.fieldNames())
    )
