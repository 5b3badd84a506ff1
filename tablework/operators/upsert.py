"""Keyed upsert: newest source row per key replaces or extends the target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.operators.numbering import first_per_group
from tablework.operators.sketch import may_hold, renew_sketches
from tablework.runtime import cut_lineage, scratch_path, small_rows


def newest_per_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    return first_per_group(df, keys, newest_first)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    newest_first: list[Column] | None = None,
    store: bool = True,
) -> DataFrame:
    """Target rows without a source counterpart, plus all source rows.

    Source keys are de-duplicated first, so both join sides hold a key once.
    The key side carries only the keys; adaptive execution turns the anti-join
    into a broadcast when its measured size allows. A NULL key fails the job
    instead of being merged or dropped. The source is needed twice, for its rows
    and for its keys, so it is computed once and written to the shared folder;
    ``store=False`` leaves out that step for a source that is a stored table.
    """
    source = source.select(*target.columns)
    for key in keys:
        checked = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"upsert: NULL {key}")))
        source = source.withColumn(key, checked.otherwise(F.col(key)))
    if newest_first:
        source = newest_per_key(source, keys, newest_first)
    if store:
        path, schema = scratch_path(source.sparkSession, "source"), source.schema
        source.write.parquet(path)
        source = target.sparkSession.read.schema(schema).parquet(path)
    kept = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    return source.unionByName(kept)


def partition_key(column: str) -> Column:
    """A partition value as text that needs no escaping in a path and is never NULL.

    Plain values stay readable (``v_...``), others are hex (``x_...``, also the
    empty text) and NULL is ``null``. A table partitioned by this key keeps NULL
    and the empty text apart; the column itself stays in the files.
    """
    text = F.col(column).cast("string")
    plain = F.concat(F.lit("v_"), text)
    coded = F.concat(F.lit("x_"), F.hex(text))
    return F.when(text.isNull(), "null").when(text.rlike("^[A-Za-z0-9.-]+$"), plain).otherwise(coded)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition: str,
    newest_first: list[Column] | None = None,
    sketch: str | None = None,
) -> list[str]:
    """Upsert into a partitioned Parquet table, rewriting only touched partitions.

    Touched are the partitions present in the source and those where matched
    keys live now, since a key may move. With ``sketch``, a folder of key
    sketches beside the table, only partitions whose sketch may know a source
    key are searched for them, and the sketches of touched partitions are
    renewed; without it, or for a source of very many keys, the keys of the whole
    table are read. Touched partitions stay a DataFrame and meet the
    table in a null-safe semi-join, so their number is not limited. The merged
    rows are written once: a dynamic overwrite puts partitions in place after
    all its tasks have read, and a run that stops half-way can be repeated.

    A Parquet partition can't tell the empty text from NULL; it is stored as
    NULL. Partition by :func:`partition_key` where the difference matters.
    Returns the touched partition values.
    """
    staged_path = scratch_path(spark, "source")
    if newest_first:
        source = newest_per_key(source, keys, newest_first)
    stored = F.nullif(F.col(partition), F.lit("")) if source.schema[partition].dataType == T.StringType() else F.col(partition)
    source.withColumn(partition, stored).write.parquet(staged_path)
    staged = spark.read.schema(source.schema).parquet(staged_path)
    target = spark.read.schema(source.schema).parquet(path).select(*source.columns)

    searched = target
    if sketch is not None:
        candidates = may_hold(spark, sketch, staged, keys, partition)
        if candidates is not None:
            searched = within_partitions(target, candidates, partition)
    moved = searched.join(staged.select(*keys), keys, "left_semi")
    touched = cut_lineage(staged.select(partition).union(moved.select(partition)).distinct())
    affected = _in(target, touched, partition, "left_semi")
    kept = affected.join(staged.select(*keys), keys, "left_anti").select(partition)
    # A dynamic overwrite leaves partitions alone that receive no row.
    emptied = _in(touched, kept.union(staged.select(partition)).distinct(), partition, "left_anti").collect()
    (
        upsert(affected, staged, keys, store=False)
        .hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in emptied:
        value = None if row[0] is None else str(row[0])
        _delete(spark, f"{path.rstrip('/')}/{names.getPartitionPathString(partition, value)}")
    if sketch is not None:
        now = spark.read.schema(source.schema).parquet(path)
        renew_sketches(within_partitions(now, touched, partition), sketch, keys, partition, touched)
    values = sorted(str(row[0]) for row in touched.collect())
    _delete(spark, staged_path)
    return values


def within_partitions(rows: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Rows of the listed partitions; a list of checked size prunes the scan as a literal filter."""
    listed = small_rows(values.select(column))
    if listed is None:
        return _in(rows, values, column, "left_semi")
    known = [r[0] for r in listed if r[0] is not None]
    among = F.col(column).isin(known) if known else F.lit(False)
    if len(known) < len(listed):
        among = among | F.col(column).isNull()
    return rows.where(among)


def _in(rows: DataFrame, values: DataFrame, column: str, how: str) -> DataFrame:
    """Rows whose value is (not) among ``values``; NULL equals NULL."""
    listed = values.select(F.col(column).alias("__listed"))
    return rows.join(listed, F.col(column).eqNullSafe(F.col("__listed")), how)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
