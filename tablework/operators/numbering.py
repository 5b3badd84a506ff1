"""Exact numbering that holds when one group owns a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.runtime import broadcast_if_small, cut_lineage, hot_keys

#: Largest group that a single window task may sort.
WINDOW_GROUP_ROWS = 1_000_000
#: Largest table that is numbered in a single task.
SINGLE_TASK_ROWS = 20_000


def number_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    max_group: int = WINDOW_GROUP_ROWS,
) -> DataFrame:
    """Add ``name``: the 0-based position of each row in its group.

    ``order`` must be total inside a group. Groups of up to ``max_group`` rows
    use a window. Larger ones are spread over range partitions and numbered by
    partition offset, so no task ever sees a whole large group. Without keys
    the whole table is one group.
    """
    if not keys:
        single = df.count() <= max_group
        return _windowed(df, [], order, name) if single else _spread(df, [], order, name)

    hot = hot_keys(df, keys, max_group)
    if hot is None:
        return _windowed(df, keys, order, name)
    match = _same_keys("r", "h", keys)
    large = df.alias("r").join(hot.alias("h"), match, "left_semi")
    rest = df.alias("r").join(hot.alias("h"), match, "left_anti")
    return _windowed(rest, keys, order, name).unionByName(_spread(large, keys, order, name))


def dense_ids(
    df: DataFrame, order: list[str], name: str = "id", max_group: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """Gap-free 0-based ids in the order of a unique business key."""
    return number_within(df, [], order, name, max_group)


def first_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of every group.

    The rank filter lets Spark cut each group to ``k`` rows per map task before
    the shuffle, so a hot key sends at most ``k`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rank", F.row_number().over(window))
        .where(F.col("__rank") <= k)
        .drop("__rank")
    )


def _same_keys(left: str, right: str, keys: list[str]) -> Column:
    match = F.lit(True)
    for key in keys:
        match = match & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return match


def _windowed(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window).cast("long") - 1)


def _spread(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Range partitions in (keys, order), then position = offset of the partition + local position."""
    # Range partitions grow with the rows; each is sorted by one task.
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // WINDOW_GROUP_ROWS + 1)
    columns = [F.col(c) for c in keys + order]
    # The positions depend on partition ids, so they are frozen before use.
    ranged = cut_lineage(
        df.repartitionByRange(parts, *columns)
        .sortWithinPartitions(*columns)
        .select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__pos"))
    )
    # One row per (key, partition): at most the hot keys plus the partitions.
    runs = ranged.groupBy(*keys, "__part").agg(
        F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    before = (
        Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = runs.select(
        *keys,
        "__part",
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
    )
    side = broadcast_if_small(offsets)
    match = _same_keys("r", "o", keys + ["__part"])
    return (
        ranged.alias("r")
        .join(side.alias("o"), match)
        .select(*[F.col(f"r.{c}") for c in df.columns], (F.col("r.__pos") + F.col("o.__shift")).alias(name))
    )
