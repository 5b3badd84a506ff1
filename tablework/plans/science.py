"""Scientific files to the catalog and to long-format tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.catalog import (
    file_metadata,
    files_by_instrument,
    recent_files,
    relocate,
    to_catalog,
)
from tablework.operators.upsert import upsert
from tablework.schemas import FILE_METADATA
from tablework.sources.files import list_science_files
from tablework.sources.tables import read_drifting, read_nodes

KEY = ["file_path"]


def newest_first() -> list[Column]:
    return [F.desc("ingestion_time")]


def ingest(
    spark: SparkSession,
    roots: list[str],
    nodes_path: str,
    now: str | None = None,
    upload_prefix: str | None = None,
) -> DataFrame:
    """Metadata of every scientific file below the roots."""
    metadata = file_metadata(list_science_files(spark, roots), read_nodes(spark, nodes_path), now)
    return relocate(metadata, upload_prefix) if upload_prefix else metadata


def merged_catalog(catalog: DataFrame, metadata: DataFrame, now: str | None = None) -> DataFrame:
    """The catalog after merging metadata of any vintage."""
    return upsert(catalog, to_catalog(metadata, now), KEY, newest_first())


def merge_snapshots(
    spark: SparkSession, catalog: DataFrame, snapshots: list[str], now: str | None = None
) -> DataFrame:
    return merged_catalog(catalog, read_drifting(spark, snapshots, FILE_METADATA), now)


def summary(catalog: DataFrame) -> dict[str, DataFrame]:
    return {"by_instrument": files_by_instrument(catalog), "recent": recent_files(catalog)}
