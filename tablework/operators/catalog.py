"""Catalog of hierarchical files: one metadata row per file and its reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.paths import (
    file_name,
    location_uri,
    output_base_name,
    safe_key,
    stem,
    uploaded_uri,
)
from tablework.functions.times import run_time
from tablework.functions.values import attribute_or, joined_text, megabytes, number_text
from tablework.operators.align import align
from tablework.operators.keys import unique_keys
from tablework.operators.nexus import whole
from tablework.operators.numbering import first_per_group
from tablework.schemas import FILE_METADATA, H5_CATALOG

# What counts as a significant dataset, and how many are listed.
SIGNIFICANT_SIZE = 100
SIGNIFICANT_COUNT = 20

# Entry-level fields of a metadata row.
ENTRY_FIELDS = ("title", "experiment_identifier", "start_time", "end_time", "duration", "run_number")

# Fields of an instrument, its sources, a sample and a user that a metadata row holds.
LEAF_FIELDS = ("name", "type", "description", "facility_user_id")

# How served files are described.
SERVING_ADAPTER = "hdf5"
SERVING_CONTENT_TYPE = "application/x-hdf5"
SERVING_TREE = "tiled.adapters.hdf5:HDF5Adapter.from_uri"


def node_text() -> Column:
    """Catalog text of a dataset: texts joined, numbers printed."""
    return F.coalesce(
        joined_text("str_values"), number_text("int_values"), number_text("dbl_values")
    )


def node_counts(nodes: DataFrame) -> DataFrame:
    """Groups and datasets per file; later chunks of a dataset do not count."""
    return (
        nodes.where("chunk_offset = 0")
        .groupBy("file_path")
        .agg(
            F.count_if(F.col("kind") == "group").cast("int").alias("group_count"),
            F.count_if(F.col("kind") == "dataset").cast("int").alias("dataset_count"),
        )
    )


def significant_datasets(
    nodes: DataFrame, min_size: int = SIGNIFICANT_SIZE, count: int = SIGNIFICANT_COUNT
) -> DataFrame:
    """The first large datasets of each file in visit order, one row each."""
    large = nodes.where(
        (F.col("kind") == "dataset") & (F.col("chunk_offset") == 0) & (F.col("size") > min_size)
    ).select("file_path", "visit_order", F.col("node_path").alias("path"), "shape", "dtype", "size")
    return first_per_group(large, ["file_path"], [F.col("visit_order")], count)


def significant_json(nodes: DataFrame, **limits: int) -> DataFrame:
    """The same as one JSON array per file; at most ``count`` items are gathered."""
    item = F.struct("visit_order", F.struct("path", "shape", "dtype", "size").alias("info"))
    return (
        significant_datasets(nodes, **limits)
        .groupBy("file_path")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select("file_path", F.to_json(F.col("items.info")).alias("significant_datasets"))
    )


def entry_metadata(nodes: DataFrame) -> DataFrame:
    """Entry, instrument, source, sample and user fields of each file.

    The first entry in visit order is used, its first instrument group and the
    last source group of that instrument. Each level is folded into the one
    above by a pre-aggregated group-by, so the rows of one file are never
    gathered in one place.
    """
    path = F.split("node_path", "/")
    level = [F.get(path, F.lit(i)) for i in range(4)]
    dataset, group = F.col("kind") == "dataset", F.col("kind") == "group"
    relevant = F.lower("g2").contains("instrument") | F.col("g2").isin("sample", "user")
    second, deep = F.get(F.split("node_path", "/"), F.lit(1)), F.col("depth")
    below = second.isin("sample", "user") | F.lower(second).contains("instrument")
    # Named fields only: whatever other arrays lie below an instrument, they aren't gathered.
    leaf = F.col("name").isin(*LEAF_FIELDS)
    wanted = nodes.where(F.col("kind").isin("group", "dataset")).where(
        (group & ((deep == 1) | ((deep == 2) | (deep == 3)) & below))
        | (dataset & (deep == 1))
        | (dataset & (deep == 2) & F.col("name").isin(*ENTRY_FIELDS))
        | (dataset & ((deep == 3) | (deep == 4)) & below & leaf)
    )
    rows = (
        whole(wanted.withColumns({v: F.when(deep > 1, F.col(v)) for v in ("str_values", "int_values", "dbl_values")}))
        .select(
            "file_path",
            "depth",
            "kind",
            "name",
            "visit_order",
            level[0].alias("g1"),
            level[1].alias("g2"),
            level[2].alias("g3"),
            F.when(group, attribute_or("attrs", "NX_class", F.lit(""))).alias("nx_class"),
            F.when(dataset, node_text()).alias("text"),
        )
        .where((F.col("depth") == 1) | F.col("g2").isin(*ENTRY_FIELDS) | relevant)
    )

    def pick(condition: Column, value: str) -> Column:
        return F.max(F.when(condition, F.col(value)))

    depth = F.col("depth")
    level3 = rows.groupBy("file_path", "g1", "g2", "g3").agg(
        F.max(F.when(depth == 1, F.col("kind"))).alias("kind1"),
        F.min(F.when(depth == 1, F.col("visit_order"))).alias("order1"),
        pick(depth == 1, "nx_class").alias("class1"),
        F.max(F.when(depth == 2, F.col("kind"))).alias("kind2"),
        F.min(F.when(depth == 2, F.col("visit_order"))).alias("order2"),
        pick(depth == 2, "nx_class").alias("class2"),
        pick(depth == 2, "text").alias("text2"),
        F.min(F.when(depth == 3, F.col("visit_order"))).alias("order3"),
        pick(depth == 3, "nx_class").alias("class3"),
        pick(depth == 3, "text").alias("text3"),
        pick((depth == 4) & (F.col("name") == "name"), "text").alias("inner_name"),
        pick((depth == 4) & (F.col("name") == "type"), "text").alias("inner_type"),
    )
    source = F.struct(
        F.coalesce("inner_name", F.lit("")).alias("source_name"),
        F.coalesce("inner_type", F.lit("")).alias("source_type"),
    )
    level2 = level3.groupBy("file_path", "g1", "g2").agg(
        *[F.max(c).alias(c) for c in ("kind1", "class1", "kind2", "class2", "text2")],
        *[F.min(c).alias(c) for c in ("order1", "order2")],
        pick(F.col("g3") == "name", "text3").alias("name"),
        pick(F.col("g3") == "description", "text3").alias("description"),
        pick(F.col("g3") == "facility_user_id", "text3").alias("facility"),
        F.max_by(
            F.when(F.col("class3") == "NXsource", source),
            F.when(F.col("class3") == "NXsource", F.col("order3")),
        ).alias("source"),
    )

    is_group = F.col("kind2") == "group"
    instrument = is_group & F.lower("g2").contains("instrument")
    parts = F.struct(
        F.coalesce("name", F.lit("")).alias("instrument_name"),
        F.col("class2").alias("instrument_type"),
        F.col("source").alias("source"),
    )

    def child(group_name: str, value: str) -> Column:
        return F.max(
            F.when(is_group & (F.col("g2") == group_name), F.coalesce(value, F.lit("")))
        )

    level1 = level2.groupBy("file_path", "g1").agg(
        F.max("kind1").alias("kind1"),
        F.max("class1").alias("class1"),
        F.min("order1").alias("order1"),
        *[
            pick((F.col("g2") == f) & (F.col("kind2") == "dataset"), "text2").alias(f)
            for f in ENTRY_FIELDS
        ],
        F.min_by(F.when(instrument, parts), F.when(instrument, F.col("order2"))).alias("instrument"),
        child("sample", "name").alias("sample_name"),
        child("sample", "description").alias("sample_description"),
        child("user", "name").alias("user_name"),
        child("user", "facility").alias("user_facility"),
    )
    entries = level1.where(
        (F.col("kind1") == "group")
        & ((F.col("class1") == "NXentry") | F.col("g1").startswith("entry"))
    )
    first = first_per_group(entries, ["file_path"], [F.col("order1")])
    defaults = {f: "0" if f == "duration" else "" for f in ENTRY_FIELDS}
    return first.select(
        "file_path",
        F.col("g1").alias("entry_name"),
        *[F.coalesce(f, F.lit(d)).alias(f) for f, d in defaults.items()],
        F.col("instrument.instrument_name").alias("instrument_name"),
        F.col("instrument.instrument_type").alias("instrument_type"),
        F.col("instrument.source.source_name").alias("source_name"),
        F.col("instrument.source.source_type").alias("source_type"),
        "sample_name",
        "sample_description",
        "user_name",
        "user_facility",
    )


def file_facts(files: DataFrame, now: Column | str | None = None) -> DataFrame:
    """Facts of a listed file (``path``, ``modificationTime``, ``length``)."""
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    return files.select(
        F.col("path").alias("file_path"),
        file_name("path").alias("file_name"),
        F.col("length").alias("file_size_bytes"),
        F.date_format("modificationTime", iso).alias("file_modified_time"),
        F.lit(None).cast("string").alias("file_created_time"),
        F.date_format(run_time(now), iso).alias("ingestion_time"),
        location_uri("path").alias("tiled_uri"),
        F.lit(SERVING_ADAPTER).alias("tiled_adapter"),
        F.lit(SERVING_CONTENT_TYPE).alias("content_type"),
        output_base_name("path").alias("base_name"),
    )


def file_metadata(files: DataFrame, nodes: DataFrame, now: Column | str | None = None) -> DataFrame:
    """The 30-column metadata row of every listed file.

    A file without nodes keeps its facts; ``extraction_error`` is carried when
    the listing has it. The root row of a file holds driver and version.
    """
    root = nodes.where((F.col("kind") == "file") & (F.col("chunk_offset") == 0)).select(
        "file_path",
        F.col("attrs")["driver"].alias("hdf5_driver"),
        F.col("attrs")["libver"].alias("hdf5_libver"),
    )
    facts = file_facts(files, now)
    if "extraction_error" in files.columns:
        errors = files.select(F.col("path").alias("file_path"), "extraction_error")
        facts = facts.join(errors, "file_path", "left")
    rows = facts
    for part in (root, node_counts(nodes), significant_json(nodes), entry_metadata(nodes)):
        rows = rows.join(part, "file_path", "left")
    rows = rows.withColumn(
        "significant_datasets",
        F.when(
            F.col("group_count").isNotNull(), F.coalesce("significant_datasets", F.lit("[]"))
        ),
    )
    return align(rows, FILE_METADATA)


def relocate(metadata: DataFrame, prefix: str) -> DataFrame:
    """Point rows at the uploaded copies of their files."""
    moved = metadata.withColumn("s3_uri", uploaded_uri(prefix, "file_name"))
    return moved.withColumn("tiled_uri", F.coalesce("s3_uri", "tiled_uri"))


def to_catalog(metadata: DataFrame, now: Column | str | None = None) -> DataFrame:
    """Align metadata of any vintage with the catalog and stamp it."""
    return align(metadata, H5_CATALOG, {"cataloged_at": run_time(now)})


def files_by_instrument(catalog: DataFrame) -> DataFrame:
    """Files and megabytes per instrument; '' and a missing name stay apart."""
    return (
        catalog.groupBy("instrument_name")
        .agg(
            F.count(F.lit(1)).alias("file_count"),
            megabytes(F.sum("file_size_bytes")).alias("total_size_mb"),
        )
        .select(
            F.coalesce("instrument_name", F.lit("Unknown")).alias("instrument"),
            "file_count",
            "total_size_mb",
        )
        .orderBy(F.desc("file_count"), "instrument")
    )


def recent_files(catalog: DataFrame, last: int = 5) -> DataFrame:
    return (
        catalog.select("file_path", "file_name", "instrument_name", "title", "cataloged_at")
        .orderBy(F.desc("cataloged_at"), "file_path")
        .limit(last)
    )


def files_of_instrument(catalog: DataFrame, instrument: str) -> DataFrame:
    """Newest runs of one instrument; the filter prunes catalog partitions."""
    return catalog.where(F.col("instrument_name") == instrument).orderBy(
        F.desc("start_time"), "file_path"
    )


def ingest_summary(metadata: DataFrame) -> DataFrame:
    return metadata.agg(
        F.count(F.lit(1)).alias("files"),
        megabytes(F.coalesce(F.sum("file_size_bytes"), F.lit(0))).alias("total_mb"),
    )


def serving_manifest(metadata: DataFrame) -> DataFrame:
    """One `{path, tree, args, metadata}` entry per file."""

    def known(column: str) -> Column:
        return F.coalesce(column, F.lit(""))

    return metadata.select(
        safe_key("file_name").alias("path"),
        F.lit(SERVING_TREE).alias("tree"),
        F.struct(F.col("tiled_uri").alias("filepath")).alias("args"),
        F.struct(
            known("title").alias("title"),
            known("instrument_name").alias("instrument"),
            known("sample_name").alias("sample"),
            known("start_time").alias("start_time"),
        ).alias("metadata"),
    )


def serving_catalog(metadata: DataFrame) -> DataFrame:
    """Unique key, location and description of every served file."""
    based = metadata.withColumn("__base", safe_key(stem("file_name")))
    return unique_keys(based, "__base", ["file_path"], "key").select(
        "key",
        location_uri("tiled_uri", fallback="file_path").alias("uri"),
        "file_name",
        *[
            F.coalesce(c, F.lit("")).alias(a)
            for c, a in (
                ("title", "title"),
                ("instrument_name", "instrument"),
                ("sample_name", "sample"),
                ("start_time", "start_time"),
            )
        ],
        F.coalesce("file_size_bytes", F.lit(0)).alias("file_size_bytes"),
    )
