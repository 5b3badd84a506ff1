"""File listing to the registry and its statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.publish import publish, stage
from tablework.operators.registry import registry_by_extension, registry_rows, registry_totals
from tablework.sinks.tables import append
from tablework.sources.files import list_files


def registry_rules() -> dict[str, Column]:
    """What a registry row must not look like."""
    return {
        "missing_path": F.col("file_path").isNull() | (F.col("file_path") == ""),
        "missing_name": F.col("file_name").isNull() | (F.col("file_name") == ""),
        "negative_size": F.col("size_bytes").isNull() | (F.col("size_bytes") < 0),
    }


def register(
    spark: SparkSession, root: str, table: str, now: str | None = None, mode: str = "append"
) -> bool:
    """List ``root`` and append the files to the registry table."""
    listing = list_files(spark, root)
    if listing is None:
        return False
    append(registry_rows(listing, now), table, mode)
    return True


def publish_listing(
    spark: SparkSession, root: str, path: str, commit_id: int, now: str | None = None
) -> bool:
    """The same through staging and an audit."""
    listing = list_files(spark, root)
    if listing is None:
        return False
    publish(stage(spark, registry_rows(listing, now)), registry_rules(), path, commit_id, now)
    return True


def stats(registry: DataFrame) -> dict[str, DataFrame]:
    return {"totals": registry_totals(registry), "by_extension": registry_by_extension(registry)}
