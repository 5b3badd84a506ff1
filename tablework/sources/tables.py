"""Parquet and JSON scans with fixed schemas."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType, StructField, StructType

from tablework.operators.align import union_aligned
from tablework.schemas import H5_NODES, LANDING, ORDER_DOC, VECTORS

#: Jobs that read footers side by side.
FOOTER_JOBS = 16


def read_landing(spark: SparkSession, root: str) -> DataFrame | None:
    """Landed orders of all days, or None when nothing has landed yet."""
    try:
        return spark.read.schema(LANDING).option("recursiveFileLookup", "true").parquet(root)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def read_days(spark: SparkSession, root: str, first: str, last: str) -> DataFrame:
    """Landed orders of a range of days; only those day folders are listed in the plan."""
    schema = StructType([*LANDING, StructField("order_day", StringType())])
    days = F.col("order_day").between(first, last)
    return spark.read.schema(schema).parquet(root).where(days).drop("order_day")


def read_head(spark: SparkSession, path: str, n: int = 5, order: list[Column | str] | None = None) -> DataFrame:
    """The first rows of a file, in a stated order if one is given."""
    rows = spark.read.parquet(path)
    return (rows.orderBy(*order) if order else rows).limit(n)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Exported order documents, one JSON object per line."""
    return spark.read.schema(ORDER_DOC).json(path)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node table; ``bulk`` is its storage partition (see the sink)."""
    return spark.read.schema(StructType([*H5_NODES, StructField("bulk", BooleanType())])).parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VECTORS).parquet(path)


def read_category(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One category table below ``root``; fields lie in one table by their category."""
    base = root.rstrip("/")
    if name in ("metadata", "daslogs", "events", "event_summary"):
        return spark.read.parquet(f"{base}/{name}")
    return spark.read.parquet(f"{base}/fields").where(F.col("category") == name).drop("category")


def vintages(spark: SparkSession, paths: list[str]) -> list[tuple[dict[str, DataType], list[str]]]:
    """Paths grouped so that no column has two types in a group, with the types of each group.

    A path's schema is merged from its footers by a Spark job; several such
    jobs run side by side. A path joins the first group it agrees with, in the
    given order, so snapshots of one vintage meet whatever columns they lack.
    """
    spark_schema = lambda path: spark.read.option("mergeSchema", "true").parquet(path).schema
    with ThreadPoolExecutor(FOOTER_JOBS) as jobs:
        schemas = list(jobs.map(spark_schema, paths))
    groups: list[tuple[dict[str, DataType], list[str]]] = []
    for path, schema in zip(paths, schemas, strict=True):
        own = {f.name: f.dataType for f in schema}
        for types, members in groups:
            if all(types.get(name, kind) == kind for name, kind in own.items()):
                types.update(own)
                members.append(path)
                break
        else:
            groups.append((own, [path]))
    return groups


def read_drifting(
    spark: SparkSession, paths: list[str], schema: StructType
) -> DataFrame:
    """Files of several vintages as one table of ``schema``.

    Files below one path share a schema up to missing columns. Paths may
    disagree on types; those that agree are read by one scan, so the plan has a
    branch per vintage and not per path.
    """
    frames = []
    for types, members in vintages(spark, paths):
        fields = [StructField(name, kind) for name, kind in types.items()]
        frames.append(spark.read.schema(StructType(fields)).parquet(*members))
    return union_aligned(frames, schema)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, counted in one job."""
    result = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        result = row if result is None else result.unionByName(row)
    return result


