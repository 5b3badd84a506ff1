"""Catalog of scientific files and serving keys."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.paths import (
    file_name,
    has_science_extension,
    location_uri,
)
from tablework.functions.values import joined_text, number_text, unwrapped_text
from tablework.operators.catalog import (
    file_facts,
    files_by_instrument,
    files_of_instrument,
    ingest_summary,
    recent_files,
    relocate,
    serving_catalog,
    serving_manifest,
    to_catalog,
)
from tablework.operators.align import align
from tablework.operators.sketch import write_sketches
from tablework.operators.upsert import upsert_partitions
from tablework.plans.science import KEY, merged_catalog, newest_first
from tablework.queries.fixtures import (
    LATER,
    METADATA_SQL,
    NOW,
    SECOND_VINTAGE_SQL,
    raw_metadata,
    second_vintage,
    table,
    times_as_text,
)
from tablework.queries.registered import ORACLES, query
from tablework.runtime import scratch_path
from tablework.schemas import FILE_METADATA, H5_CATALOG
from tablework.sinks.tables import append, create_keyed_catalog_table, create_namespace, with_instrument, write_manifest, write_snapshot
from tablework.sources.tables import read_drifting

ALIGNED_SQL = f"""{METADATA_SQL},
aligned AS (
  SELECT file_path, file_name, file_size_bytes, replace(ingestion_time, 'T', ' ') AS ingestion_time,
         try_cast(group_count AS INTEGER) AS group_count, title, start_time,
         try_cast(duration AS DOUBLE) AS duration, instrument_name, tiled_uri, extraction_error
  FROM meta)"""


_NULLS = {"bigint": "NULL::BIGINT", "double": "NULL::DOUBLE"}


def _catalog_columns(filled: dict[str, str]) -> str:
    """All columns of the catalog, counts as text; those that are not filled are NULL."""
    nulls = {f.name: _NULLS.get(f.dataType.simpleString(), "NULL::VARCHAR") for f in H5_CATALOG}
    return ", ".join(f"{filled.get(name, null)} AS {name}" for name, null in nulls.items())


def _all_columns(catalog: DataFrame) -> DataFrame:
    """Every catalog column, with counts (which may be NULL) as text."""
    counts = {c: F.col(c).cast("string") for c in ("group_count", "dataset_count")}
    return times_as_text(catalog.withColumns(counts)).select(*H5_CATALOG.fieldNames())


_ALIGNED = {
    name: name
    for name in "file_path file_name file_size_bytes ingestion_time title start_time duration instrument_name tiled_uri extraction_error".split()
} | {"group_count": "group_count::VARCHAR", "cataloged_at": "'2024-01-01 00:00:00'"}
_SECOND = {name: name for name in "file_path file_name file_size_bytes title duration instrument_name".split()} | {
    "ingestion_time": "replace(ingestion_time, 'T', ' ')",
    "cataloged_at": "'2024-01-02 00:00:00'",
}


@query(f"WITH {ALIGNED_SQL} SELECT {_catalog_columns(_ALIGNED)} FROM aligned")
def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad numbers become NULL, missing columns are added, order is fixed."""
    return _all_columns(to_catalog(raw_metadata(spark, sf_dir), NOW))


CATALOG_SQL = f"""{ALIGNED_SQL}, {SECOND_VINTAGE_SQL},
catalog AS (
  SELECT file_path, file_size_bytes, replace(ingestion_time, 'T', ' ') AS ingestion_time, title,
         duration, instrument_name, '2024-01-02 00:00:00' AS cataloged_at, NULL AS start_time FROM second
  UNION ALL
  SELECT file_path, file_size_bytes, ingestion_time, title, duration, instrument_name,
         '2024-01-01 00:00:00', start_time
  FROM aligned a WHERE NOT EXISTS (SELECT 1 FROM second s WHERE s.file_path = a.file_path))"""


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_catalog(
        to_catalog(raw_metadata(spark, sf_dir), NOW), second_vintage(spark, sf_dir), LATER
    )


FULL_CATALOG_SQL = f"""{ALIGNED_SQL}, {SECOND_VINTAGE_SQL},
catalog AS (
  SELECT {_catalog_columns(_SECOND)} FROM second
  UNION ALL
  SELECT {_catalog_columns(_ALIGNED)} FROM aligned a WHERE NOT EXISTS (SELECT 1 FROM second s WHERE s.file_path = a.file_path))"""


@query(f"WITH {FULL_CATALOG_SQL} SELECT * FROM catalog")
def catalog_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_columns(_catalog(spark, sf_dir))


@query(
    f"""WITH {CATALOG_SQL}
    SELECT coalesce(instrument_name, 'Unknown') AS instrument, count(*) AS file_count,
           sum(file_size_bytes)::BIGINT / 1024 / 1024 AS total_size_mb
    FROM catalog GROUP BY instrument_name"""
)
def catalog_by_instrument(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files_by_instrument(_catalog(spark, sf_dir))


@query(
    f"""WITH {CATALOG_SQL}
    SELECT file_path, instrument_name, title, cataloged_at FROM catalog
    ORDER BY cataloged_at DESC, file_path LIMIT 5"""
)
def catalog_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return times_as_text(recent_files(_catalog(spark, sf_dir))).drop("file_name")


@query(
    f"""WITH {CATALOG_SQL}
    SELECT file_path, title, start_time FROM catalog WHERE instrument_name = 'de'"""
)
def catalog_filter_instrument(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files_of_instrument(_catalog(spark, sf_dir), "de")
    return found.select("file_path", "title", "start_time")


@query(
    f"""WITH {METADATA_SQL}
    SELECT count(*) AS files, sum(file_size_bytes)::BIGINT / 1024 / 1024 AS total_mb FROM meta"""
)
def catalog_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_summary(align(raw_metadata(spark, sf_dir), FILE_METADATA))


@query(
    f"""WITH {METADATA_SQL}
    SELECT file_path, extraction_error FROM meta WHERE extraction_error IS NOT NULL"""
)
def failed_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose structure could not be read stay in the catalog with their error."""
    catalog = to_catalog(raw_metadata(spark, sf_dir), NOW)
    return catalog.where("extraction_error IS NOT NULL").select("file_path", "extraction_error")


@query(
    f"""WITH {METADATA_SQL}, {SECOND_VINTAGE_SQL}
    SELECT file_path, file_size_bytes, title, instrument_name, try_cast(duration AS DOUBLE) AS duration
    FROM meta
    UNION ALL SELECT file_path, file_size_bytes, title, instrument_name, duration FROM second
    UNION ALL SELECT file_path, file_size_bytes, 'stale', instrument_name, duration FROM second
    WHERE toxic = 1"""
)
def metadata_drift_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots whose columns and types differ, read as one table."""
    root = scratch_path(spark, "snapshots")
    paths = [
        write_snapshot(raw_metadata(spark, sf_dir), root, "20240102_080000"),
        write_snapshot(second_vintage(spark, sf_dir), root, "20240103_080000"),
    ]
    return read_drifting(spark, paths, FILE_METADATA).select(
        "file_path", "file_size_bytes", "title", "instrument_name", "duration"
    )


@query(
    f"""WITH {METADATA_SQL}
    SELECT file_path FROM meta WHERE regexp_matches(file_path, '[^/]\\.(h5|hdf5|nxs|nx5)$', 'i')"""
)
def science_file_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_metadata(spark, sf_dir).select("file_path")
    return rows.where(has_science_extension("file_path"))


SERVED_SQL = f"""{METADATA_SQL},
served AS (
  SELECT *, replace(replace(regexp_replace(file_name, '^(.+)\\.[^.]*$', '\\1'), '.', '_'), '-', '_') AS base,
         coalesce(nullif(tiled_uri, ''), file_path) AS loc
  FROM meta),
keyed AS (
  SELECT *, row_number() OVER (PARTITION BY base ORDER BY file_path) - 1 AS n,
         CASE WHEN regexp_matches(loc, '^(file|s3)://') THEN loc ELSE 'file://' || loc END AS uri
  FROM served)"""


@query(
    f"""WITH {SERVED_SQL}
    SELECT CASE n WHEN 0 THEN base ELSE base || '_' || n END AS key, uri, file_name, title,
           coalesce(instrument_name, '') AS instrument, '' AS sample, start_time, file_size_bytes
    FROM keyed"""
)
def serving_catalog_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique keys: all files of a source share one file name."""
    return serving_catalog(align(raw_metadata(spark, sf_dir), FILE_METADATA))


@query(f"WITH {SERVED_SQL} SELECT file_path, uri FROM keyed")
def serving_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_metadata(spark, sf_dir)
    return rows.select("file_path", location_uri("tiled_uri", fallback="file_path").alias("uri"))


@query(
    f"""WITH {METADATA_SQL}
    SELECT file_path, 's3://bucket/bronze/hdf5/' || file_name AS tiled_uri FROM meta"""
)
def relocated_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = relocate(raw_metadata(spark, sf_dir), "s3://bucket/bronze/hdf5")
    return moved.select("file_path", "tiled_uri")


@query(
    f"""WITH {METADATA_SQL}
    SELECT replace(replace(file_name, '.', '_'), '-', '_') AS path,
           'tiled.adapters.hdf5:HDF5Adapter.from_uri' AS tree, tiled_uri AS filepath, title,
           coalesce(instrument_name, '') AS instrument, '' AS sample, start_time
    FROM meta"""
)
def serving_manifest_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = serving_manifest(align(raw_metadata(spark, sf_dir), FILE_METADATA))
    return entries.select("path", "tree", "args.filepath", "metadata.*")


@query(
    r"""SELECT url AS file_path, regexp_extract(url, '[^/]+$', 0) AS file_name,
           length(html) AS file_size_bytes, 'file://' || url AS tiled_uri, 'hdf5' AS tiled_adapter,
           'application/x-hdf5' AS content_type,
           replace(replace(regexp_replace(regexp_extract(url, '[^/]+$', 0), '^(.+)\.[^.]*$', '\1'),
                   '.nxs', ''), '.h5', '') AS base_name
    FROM pages"""
)
def listed_file_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of listed files, with page addresses as paths."""
    files = table(spark, sf_dir, "pages").select(
        F.col("url").alias("path"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modificationTime"),
        F.length("html").cast("bigint").alias("length"),
    )
    return file_facts(files, NOW).drop(
        "file_modified_time", "file_created_time", "ingestion_time"
    )


@query(
    """SELECT conv_id, turn,
           array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), ', ') AS joined,
           '[' || conv_id || ', ' || turn || ']' AS numbers, turn::VARCHAR AS single, '' AS nothing,
           '[' || array_to_string(string_split(role, 's'), ', ') || ']' AS unwrapped
    FROM conversations WHERE contains(role, 's')
    UNION ALL
    SELECT conv_id, turn,
           array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), ', '),
           '[' || conv_id || ', ' || turn || ']', turn::VARCHAR, '', role
    FROM conversations WHERE NOT contains(role, 's')"""
)
def array_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of lines, of numbers, of one number and of none as text."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        joined_text(F.split("text", "\n", -1)).alias("joined"),
        number_text(F.array("conv_id", "turn")).alias("numbers"),
        number_text(F.array("turn")).alias("single"),
        number_text(F.array().cast("array<bigint>")).alias("nothing"),
        unwrapped_text(F.split("role", "s", -1)).alias("unwrapped"),
    )


@query(
    r"""SELECT url, regexp_extract(url, '[^/]+$', 0) AS name FROM pages"""
)
def path_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("url", file_name("url").alias("name"))


def _stored_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The managed catalog table, created by DDL, filled, and merged with the second vintage.

    Some instruments are missing and some empty; merged files move to another
    one. The table is read by its location, so its name isn't needed after that.
    """
    space, path, sketch = f"catalog_{uuid.uuid4().hex[:8]}", scratch_path(spark, "catalog"), scratch_path(spark, "catalog-keys")
    create_namespace(spark, space)
    create_keyed_catalog_table(spark, f"{space}.h5_catalog", path)
    append(with_instrument(to_catalog(raw_metadata(spark, sf_dir), NOW)), f"{space}.h5_catalog")
    schema = spark.table(f"{space}.h5_catalog").schema
    stored = spark.read.schema(schema).parquet(path)
    write_sketches(stored, sketch, KEY, "instrument_key")
    source = with_instrument(to_catalog(second_vintage(spark, sf_dir), LATER))
    upsert_partitions(spark, path, source, KEY, "instrument_key", newest_first(), sketch)
    spark.sql(f"DROP NAMESPACE {space} CASCADE")
    return spark.read.schema(schema).parquet(path)


@query(f"WITH {FULL_CATALOG_SQL} SELECT * FROM catalog")
def catalog_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every row of the merged table."""
    return _all_columns(_stored_catalog(spark, sf_dir))


@query(
    f"""WITH {CATALOG_SQL}
    SELECT file_path, title, start_time FROM catalog WHERE instrument_name = 'de'"""
)
def catalog_stored_instrument(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One instrument of the stored table; the key prunes its partitions."""
    stored = _stored_catalog(spark, sf_dir).where(F.col("instrument_key") == "v_de")
    return files_of_instrument(stored, "de").select("file_path", "title", "start_time")


@query(ORACLES["serving_catalog_entries"])
def serving_catalog_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving entries from metadata that was stored as Parquet."""
    path = scratch_path(spark, "metadata")
    align(raw_metadata(spark, sf_dir), FILE_METADATA).write.parquet(path)
    return serving_catalog(spark.read.schema(FILE_METADATA).parquet(path))


@query(ORACLES["serving_manifest_entries"])
def manifest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest written as JSON and read again."""
    path = scratch_path(spark, "manifest")
    entries = serving_manifest(align(raw_metadata(spark, sf_dir), FILE_METADATA))
    write_manifest(entries, path)
    return spark.read.schema(entries.schema).json(path).select("path", "tree", "args.filepath", "metadata.*")
