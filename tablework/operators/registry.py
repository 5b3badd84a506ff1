"""File registry: rows from a listing, appends and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.paths import file_extension, file_name
from tablework.functions.times import run_time


def registry_rows(listing: DataFrame, now: Column | str | None = None) -> DataFrame:
    """Five registry columns from a listing with ``path`` and ``length``."""
    return listing.select(
        F.col("path").alias("file_path"),
        file_name("path").alias("file_name"),
        file_extension("path").alias("file_extension"),
        F.col("length").alias("size_bytes"),
        run_time(now).alias("ingested_at"),
    )


def new_only(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows whose path is not registered yet."""
    known = registry.select("file_path").distinct()
    return rows.join(known, "file_path", "left_anti").select(*rows.columns)


def registry_totals(registry: DataFrame) -> DataFrame:
    return registry.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"),
        F.count_distinct("file_extension").alias("unique_extensions"),
    )


def registry_by_extension(registry: DataFrame, top: int = 10) -> DataFrame:
    return (
        registry.groupBy(F.coalesce("file_extension", F.lit("no-ext")).alias("extension"))
        .agg(F.count(F.lit(1)).alias("count"), F.sum("size_bytes").alias("total_bytes"))
        .orderBy(F.desc("count"), "extension")
        .limit(top)
    )
