"""File listings; only metadata is read, file contents are pruned from the scan."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.paths import SCIENCE_EXTENSIONS, has_science_extension

LISTING = "path string, modificationTime timestamp, length bigint"


def list_files(spark: SparkSession, root: str) -> DataFrame | None:
    """Every file below ``root``, or None when there is no such folder."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*")
            .load(root)
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return files.select("path", "modificationTime", "length")


def list_prefix(listing: DataFrame, prefix: str, max_keys: int = 20) -> DataFrame:
    """The first ``max_keys`` paths that start with ``prefix``."""
    return (
        listing.where(F.col("path").startswith(prefix)).orderBy("path").limit(max_keys)
    )


def list_science_files(
    spark: SparkSession,
    roots: list[str],
    extensions: tuple[str, ...] = SCIENCE_EXTENSIONS,
) -> DataFrame:
    """Scientific files below several roots; a missing root is skipped."""
    result = spark.createDataFrame([], LISTING)
    for root in roots:
        files = list_files(spark, root)
        if files is not None:
            result = result.unionByName(files)
    return result.where(has_science_extension("path", extensions))
