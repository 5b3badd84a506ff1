"""Tables derived from the node table."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.values import attribute_or, first_or
from tablework.operators import nexus
from tablework.operators.catalog import (
    entry_metadata,
    file_metadata,
    node_counts,
    significant_datasets,
)
from tablework.queries.fixtures import (
    EVENTS_SQL,
    NOW,
    PULSE_LOG,
    RUN_NODES_SQL,
    event_nodes,
    run_file_path,
    run_nodes,
    table,
    times_as_text,
)
from tablework.queries.registered import query
from tablework.runtime import scratch_path
from tablework.sinks.tables import create_namespace, write_categories, write_node_table, write_nodes
from tablework.sources.tables import read_category, read_nodes

def _stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event file as a stored node table, scalars apart from large arrays."""
    path = scratch_path(spark, "nodes")
    write_nodes(event_nodes(spark, sf_dir), path)
    return read_nodes(spark, path)


RUN = "'/runs/run-' || s_suppkey || '.nxs.h5'"
_RUN_VALUES = {
    "title": "'run of ' || s_name",
    "run_number": "s_suppkey",
    "experiment_identifier": "CASE WHEN s_acctbal >= 1000 THEN 'IPTS-' || s_suppkey END",
    "duration": "s_acctbal",
    "start_time": "'2024-01-01T00:00:00'",
}


@query(
    f"""WITH {RUN_NODES_SQL}
    SELECT file_path, count(*) FILTER (kind = 'group')::INTEGER AS group_count,
           count(*) FILTER (kind = 'dataset')::INTEGER AS dataset_count
    FROM nodes GROUP BY file_path"""
)
def file_node_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return node_counts(run_nodes(spark, sf_dir))


@query(
    f"""WITH {RUN_NODES_SQL}
    SELECT file_path, path, size::BIGINT AS size FROM (
      SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY visit_order) AS rn
      FROM nodes WHERE kind = 'dataset' AND size > 100)
    WHERE rn <= 20"""
)
def file_significant_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return significant_datasets(run_nodes(spark, sf_dir)).select("file_path", "path", "size")


@query(
    f"""SELECT {RUN} AS file_path, 'entry' AS entry_name, 'run of ' || s_name AS title,
           CASE WHEN s_acctbal >= 1000 THEN 'IPTS-' || s_suppkey ELSE '' END AS experiment_identifier,
           '2024-01-01T00:00:00' AS start_time, '' AS end_time, s_suppkey::VARCHAR AS run_number,
           s_acctbal AS duration, 'INST_' || s_nationkey AS instrument_name,
           'NXinstrument' AS instrument_type, 'source ' || s_nationkey AS source_name,
           'pulsed' AS source_type, CASE WHEN s_acctbal >= 0 THEN s_name END AS sample_name,
           CASE WHEN s_acctbal >= 0 THEN 'sample of ' || s_name END AS sample_description,
           'user ' || s_nationkey AS user_name, 'u' || s_nationkey AS user_facility
    FROM supplier"""
)
def file_entry_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entry_metadata(run_nodes(spark, sf_dir))
    return rows.withColumn("duration", F.col("duration").try_cast("double"))


@query(
    f"""WITH {RUN_NODES_SQL},
    big AS (SELECT file_path, '[' || string_agg('{{"path":"' || path || '","shape":[' || size || '],"dtype":"int","size":' || size || '}}',
                                                ',' ORDER BY visit_order) || ']' AS listed FROM (
        SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY visit_order) AS rn
        FROM nodes WHERE kind = 'dataset' AND size > 100) WHERE rn <= 20 GROUP BY file_path),
    counts AS (SELECT file_path, count(*) FILTER (kind = 'group')::INTEGER AS group_count,
                      count(*) FILTER (kind = 'dataset')::INTEGER AS dataset_count FROM nodes GROUP BY file_path)
    SELECT {RUN} AS file_path, 'run-' || s_suppkey || '.nxs.h5' AS file_name, s_suppkey AS file_size_bytes,
           '2024-01-01T00:00:00' AS file_modified_time, NULL::VARCHAR AS file_created_time,
           '2024-01-01T00:00:00' AS ingestion_time, 'file://' || {RUN} AS tiled_uri, 'hdf5' AS tiled_adapter,
           'application/x-hdf5' AS content_type, 'sec2' AS hdf5_driver, 'v110' AS hdf5_libver,
           group_count, dataset_count, coalesce(listed, '[]') AS significant_datasets,
           'entry' AS entry_name, 'run of ' || s_name AS title,
           CASE WHEN s_acctbal >= 1000 THEN 'IPTS-' || s_suppkey ELSE '' END AS experiment_identifier,
           '2024-01-01T00:00:00' AS start_time, '' AS end_time, s_acctbal AS duration, s_suppkey::VARCHAR AS run_number,
           'INST_' || s_nationkey AS instrument_name, 'NXinstrument' AS instrument_type,
           'source ' || s_nationkey AS source_name, 'pulsed' AS source_type,
           CASE WHEN s_acctbal >= 0 THEN s_name END AS sample_name,
           CASE WHEN s_acctbal >= 0 THEN 'sample of ' || s_name END AS sample_description,
           'user ' || s_nationkey AS user_name, 'u' || s_nationkey AS user_facility, NULL::VARCHAR AS extraction_error
    FROM supplier JOIN counts ON counts.file_path = {RUN} LEFT JOIN big ON big.file_path = {RUN}"""
)
def file_metadata_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full metadata row of every file, joined from its parts: all thirty columns."""
    files = table(spark, sf_dir, "supplier").select(
        run_file_path().alias("path"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modificationTime"),
        F.col("s_suppkey").alias("length"),
    )
    return file_metadata(files, run_nodes(spark, sf_dir), NOW)


@query(
    f"""SELECT {RUN} AS source_path, 'run-' || s_suppkey || '.nxs.h5' AS source_file,
           {", ".join(f"({_RUN_VALUES.get(f, 'NULL')})::VARCHAR AS {f}" for f in nexus.RUN_FIELDS)},
           'run-' || s_suppkey AS file_attr_file_name, 'sec2' AS file_attr_driver, 'v110' AS file_attr_libver,
           'NXentry' AS entry_attr_nx_class, '2024-01-01 00:00:00' AS ingestion_time
    FROM supplier"""
)
def file_run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-level metadata, all of its columns."""
    rows = nexus.run_metadata(run_nodes(spark, sf_dir), now=NOW)
    return times_as_text(
        rows.select(
            "source_path", "source_file", *nexus.RUN_FIELDS,
            *[F.col("file_attrs")[a].alias(f"file_attr_{a}") for a in ("file_name", "driver", "libver")],
            F.col("entry_attrs")["NX_class"].alias("entry_attr_nx_class"), "ingestion_time",
        )
    )


@query(
    f"""SELECT {RUN} AS file_path, 'file_attr_driver' AS attribute, 'sec2' AS value FROM supplier
    UNION ALL SELECT {RUN}, 'file_attr_libver', 'v110' FROM supplier
    UNION ALL SELECT {RUN}, 'file_attr_file_name', 'run-' || s_suppkey FROM supplier
    UNION ALL SELECT {RUN}, 'entry_attr_NX_class', 'NXentry' FROM supplier
    UNION ALL SELECT {RUN}, 'entry_attr_NX_class', 'NXentry' FROM supplier"""
)
def file_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of the file and of its two entries."""
    return nexus.attribute_rows(run_nodes(spark, sf_dir))


@query(
    f"""SELECT {RUN} AS file_path, 'description' AS field, 'sample of ' || s_name AS value
    FROM supplier WHERE s_acctbal >= 0
    UNION ALL SELECT {RUN}, 'name', s_name FROM supplier WHERE s_acctbal >= 0
    UNION ALL SELECT {RUN}, 'mass', s_acctbal::VARCHAR FROM supplier WHERE s_acctbal >= 0"""
)
def sample_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nexus.sample_fields(run_nodes(spark, sf_dir))
    return rows.select("file_path", "field", "value")


@query(f"SELECT {RUN} AS file_path, s_acctbal AS mass, s_name AS name FROM supplier WHERE s_acctbal >= 0")
def sample_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen sample fields as columns."""
    rows = nexus.wide_fields(nexus.sample_fields(run_nodes(spark, sf_dir)), ["mass", "name"])
    return rows.select("file_path", F.col("mass").try_cast("double").alias("mass"), "name")


@query(
    f"""SELECT {RUN} AS file_path, f.field, CASE f.field WHEN 'beamline' THEN s_nationkey::VARCHAR
           WHEN 'name' THEN 'INST_' || s_nationkey ELSE '<xml/>' END AS value
    FROM supplier, (VALUES ('beamline'), ('name'), ('instrument_xml_data')) AS f(field)"""
)
def instrument_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nexus.instrument_fields(run_nodes(spark, sf_dir)).select("file_path", "field", "value")


@query(
    f"""SELECT {RUN} AS file_path, 'user' AS user_id, 'facility_user_id' AS field,
           'u' || s_nationkey AS value FROM supplier
    UNION ALL SELECT {RUN}, 'user', 'name', 'user ' || s_nationkey FROM supplier
    UNION ALL SELECT {RUN}, 'user1', 'role', '[, local contact, ]' FROM supplier"""
)
def user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nexus.user_rows(run_nodes(spark, sf_dir))
    return rows.select("file_path", F.col("group").alias("user_id"), "field", "value")


@query(
    f"""SELECT {RUN} AS file_path, 'reducer' AS component, 'authors' AS field, '[Ada, Grace]' AS value
    FROM supplier
    UNION ALL SELECT {RUN}, 'reducer', 'version', 'v' || s_nationkey FROM supplier
    UNION ALL SELECT {RUN}, 'writer', 'version', 'w1' FROM supplier"""
)
def software_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nexus.software_rows(run_nodes(spark, sf_dir))
    return rows.select("file_path", F.col("group").alias("component"), "field", "value")


@query(
    f"""SELECT {RUN} AS file_path, 'entry/sample' AS node_path, 'NXsample' AS nx_class, 'none' AS units,
           s_name AS name FROM supplier WHERE s_acctbal >= 0
    UNION ALL
    SELECT {RUN}, 'entry/user1', 'NXuser', 'none', 'unnamed' FROM supplier"""
)
def attribute_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute and scalar lookups with their defaults."""
    nodes = run_nodes(spark, sf_dir)
    groups = nodes.where(F.col("node_path").isin("entry/sample", "entry/user1"))
    names = nodes.where(F.col("name") == "name").select(
        "file_path", F.col("parent_path").alias("node_path"), "str_values"
    )
    return groups.drop("str_values").join(names, ["file_path", "node_path"], "left").select(
        "file_path",
        "node_path",
        attribute_or("attrs", "NX_class", F.lit("")).alias("nx_class"),
        attribute_or("attrs", "units", F.lit("none")).alias("units"),
        first_or("str_values", F.lit("unnamed")).alias("name"),
    )


DASLOG_SQL = f"""{EVENTS_SQL},
daslog AS (
  SELECT event_type AS log_name, idx AS point_idx, 'dev-' || event_type AS device_name,
         length(event_type)::VARCHAR AS device_id, t AS time,
         CASE event_type WHEN '{PULSE_LOG}' THEN 1.0 ELSE value END AS value,
         NULL::DOUBLE AS average_value, lowest AS min_value, highest AS max_value
  FROM numbered JOIN facts USING (event_type) WHERE kept
  UNION ALL SELECT 'idle', NULL, 'nothing', NULL, NULL, NULL, NULL, NULL, NULL)"""


@query(f"WITH {DASLOG_SQL} SELECT * REPLACE (coalesce(point_idx, -1) AS point_idx) FROM daslog")
def daslog_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nexus.daslog_rows(_stored_events(spark, sf_dir)).drop("file_path")
    return rows.withColumns(
        {"value": F.col("value").cast("double"), "point_idx": F.coalesce("point_idx", F.lit(-1))}
    )


@query(
    """SELECT name, (row_number() OVER (ORDER BY name) - 1)::INTEGER AS position
    FROM (SELECT DISTINCT event_type AS name FROM events UNION ALL SELECT 'idle')"""
)
def ordered_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nexus.group_names(event_nodes(spark, sf_dir), "entry/DASlogs").select("name", "position")


EVENT_ROWS_SQL = f"""{EVENTS_SQL},
event_rows AS (
  SELECT event_type || '_events' AS bank, idx AS event_idx, user_id AS event_id, value AS time_offset
  FROM numbered)"""


@query(f"WITH {EVENT_ROWS_SQL} SELECT * FROM event_rows")
def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nexus.event_rows(_stored_events(spark, sf_dir)).drop("file_path")


def _uneven_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event file with offsets and log values chunked elsewhere than ids and times."""
    nodes = event_nodes(spark, sf_dir)
    other = F.col("name").isin("event_time_offset", "value") & (F.col("size") > 0)
    cut = nexus.in_cells(nodes.where(other), 370).withColumn("chunk_offset", F.col("start").cast(nodes.schema["chunk_offset"].dataType))
    return nodes.where(~other).unionByName(cut.select(*nodes.columns))


@query(f"WITH {EVENT_ROWS_SQL} SELECT * FROM event_rows")
def event_rows_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events when parallel datasets have different chunk lengths."""
    return nexus.event_rows(_uneven_nodes(spark, sf_dir)).drop("file_path")


@query(f"WITH {DASLOG_SQL} SELECT * REPLACE (coalesce(point_idx, -1) AS point_idx) FROM daslog")
def daslog_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nexus.daslog_rows(_uneven_nodes(spark, sf_dir)).drop("file_path")
    return rows.withColumns(
        {"value": F.col("value").cast("double"), "point_idx": F.coalesce("point_idx", F.lit(-1))}
    )


@query(f"WITH {EVENT_ROWS_SQL} SELECT * FROM event_rows WHERE event_idx < 700")
def event_rows_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first events of each bank, when a reader asks for that many only."""
    return nexus.event_rows(_stored_events(spark, sf_dir), max_events=700).drop("file_path")


@query(f"WITH {EVENT_ROWS_SQL} SELECT * FROM event_rows")
def event_rows_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from a node table bucketed by chunk position: no shuffle on reading."""
    space = f"nodes_{uuid.uuid4().hex[:8]}"
    create_namespace(spark, space)
    table_name = f"{space}.h5_nodes"
    write_node_table(event_nodes(spark, sf_dir), table_name, 8, scratch_path(spark, "nodes"))
    return nexus.event_rows(spark.table(table_name)).drop("file_path")


@query(
    f"""WITH {EVENTS_SQL}
    SELECT event_type || '_events' AS bank, n AS total_counts, days AS n_pulses, n AS events_extracted
    FROM facts
    UNION ALL SELECT 'empty_events', -1, 0, 0
    UNION ALL SELECT 'monitor1', -1, 0, 0"""
)
def bank_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nexus.bank_summary(_stored_events(spark, sf_dir)).drop("file_path")
    return rows.withColumn("total_counts", F.coalesce("total_counts", F.lit(-1)))


@query("SELECT 0::BIGINT AS misaligned, count(*) AS events FROM events")
def chunk_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel datasets meet in every chunk."""
    nodes = _stored_events(spark, sf_dir)
    none = F.lit(0).cast("bigint")
    bad = nexus.misaligned_chunks(nodes).select(F.lit(1).cast("bigint").alias("misaligned"), none.alias("events"))
    good = nexus.bank_summary(nodes).select(none.alias("misaligned"), F.col("events_extracted").alias("events"))
    return bad.unionByName(good).agg(
        F.sum("misaligned").alias("misaligned"), F.sum("events").alias("events")
    )


@query(
    f"""WITH {EVENTS_SQL}
    SELECT event_type AS log_name, idx AS point_idx,
           CASE event_type WHEN 'click' THEN 'BIGINT' WHEN 'view' THEN 'STRING' ELSE 'DOUBLE' END AS kind,
           CASE event_type WHEN 'click' THEN floor(value * 100)::BIGINT ELSE -1 END AS whole,
           CASE event_type WHEN 'click' THEN -1.0 WHEN 'view' THEN -1.0 WHEN '{PULSE_LOG}' THEN 1.0 ELSE value END AS number,
           CASE event_type WHEN 'view' THEN 'v' || floor(value * 100)::BIGINT ELSE '' END AS word
    FROM numbered WHERE kept"""
)
def daslog_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log values with the type they were stored with: whole numbers, numbers and texts."""
    nodes = _stored_events(spark, sf_dir)
    of = lambda log: (F.col("name") == "value") & (F.col("parent_path") == f"entry/DASlogs/{log}")
    hundredths = F.transform("dbl_values", lambda v: F.floor(v * 100))
    kinds = {
        "int_values": F.when(of("click"), hundredths).otherwise(F.col("int_values")),
        "str_values": F.when(of("view"), F.transform(hundredths, lambda v: F.concat(F.lit("v"), v))).otherwise(F.col("str_values")),
        "dbl_values": F.when(~of("click") & ~of("view"), F.col("dbl_values")),
    }
    points = nexus.daslog_rows(nodes.withColumns(kinds), typed=True).where("point_idx IS NOT NULL")
    kind = F.schema_of_variant("typed")

    def read(name: str, otherwise: str, variant: str) -> Column:
        return F.when(kind == variant, F.try_variant_get("typed", "$", name)).otherwise(F.lit(otherwise).cast(name))

    return points.select(
        "log_name",
        "point_idx",
        kind.alias("kind"),
        read("bigint", "-1", "BIGINT").alias("whole"),
        read("double", "-1", "DOUBLE").alias("number"),
        read("string", "", "STRING").alias("word"),
    )


CELLS_SQL = f"""{EVENT_ROWS_SQL}, {DASLOG_SQL.removeprefix(EVENTS_SQL + ',').strip()},
runs AS (SELECT 'run-' || s_suppkey AS base_name, * FROM supplier),
cells AS (
  SELECT 'sample' AS category, base_name, 'sample' AS grp, f.field, -1 AS idx,
         CASE f.field WHEN 'description' THEN 'sample of ' || s_name WHEN 'name' THEN s_name ELSE s_acctbal::VARCHAR END AS text,
         -1.0::DOUBLE AS num, -1.0::DOUBLE AS extra
  FROM runs, (VALUES ('description'), ('name'), ('mass')) AS f(field) WHERE s_acctbal >= 0
  UNION ALL
  SELECT 'instrument', base_name, 'instrument', f.field, -1,
         CASE f.field WHEN 'beamline' THEN s_nationkey::VARCHAR WHEN 'name' THEN 'INST_' || s_nationkey ELSE '<xml/>' END, -1, -1
  FROM runs, (VALUES ('beamline'), ('name'), ('instrument_xml_data')) AS f(field)
  UNION ALL SELECT 'users', base_name, 'user', 'facility_user_id', -1, 'u' || s_nationkey, -1, -1 FROM runs
  UNION ALL SELECT 'users', base_name, 'user', 'name', -1, 'user ' || s_nationkey, -1, -1 FROM runs
  UNION ALL SELECT 'users', base_name, 'user1', 'role', -1, '[, local contact, ]', -1, -1 FROM runs
  UNION ALL SELECT 'software', base_name, 'reducer', 'authors', -1, '[Ada, Grace]', -1, -1 FROM runs
  UNION ALL SELECT 'software', base_name, 'reducer', 'version', -1, 'v' || s_nationkey, -1, -1 FROM runs
  UNION ALL SELECT 'software', base_name, 'writer', 'version', -1, 'w1', -1, -1 FROM runs
  UNION ALL
  SELECT 'metadata', base_name, 'run', f.field, -1,
         CASE f.field WHEN 'duration' THEN s_acctbal::VARCHAR WHEN 'experiment_identifier' THEN 'IPTS-' || s_suppkey
              WHEN 'run_number' THEN s_suppkey::VARCHAR WHEN 'start_time' THEN '2024-01-01T00:00:00' ELSE 'run of ' || s_name END, -1, -1
  FROM runs, (VALUES ('duration'), ('experiment_identifier'), ('run_number'), ('start_time'), ('title')) AS f(field)
  WHERE f.field <> 'experiment_identifier' OR s_acctbal >= 1000
  UNION ALL SELECT 'metadata', 'events', 'run', 'title', -1, 'event run', -1, -1
  UNION ALL SELECT 'metadata', 'events', 'run', 'total_counts', -1, count(*)::VARCHAR, -1, -1 FROM events
  UNION ALL
  SELECT 'daslogs', 'events', log_name, 'point', coalesce(point_idx, -1), device_name || '/' || coalesce(device_id, ''),
         coalesce(time, -1), coalesce(value, -1) FROM daslog
  UNION ALL SELECT 'events', 'events', bank, 'event', event_idx, event_id::VARCHAR, time_offset, -1 FROM event_rows
  UNION ALL SELECT 'event_summary', 'events', event_type || '_events', 'bank', days, n::VARCHAR, n, -1 FROM facts
  UNION ALL SELECT 'event_summary', 'events', 'empty_events', 'bank', 0, '-1', 0, -1
  UNION ALL SELECT 'event_summary', 'events', 'monitor1', 'bank', 0, '-1', 0, -1)"""


def _category_cells(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A category table as cells: category, base_name, grp, field, idx, text, num and extra."""
    rows = read_category(spark, root, name)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0))
    none, nothing = F.lit(-1).cast("bigint"), F.lit(-1.0)
    if name == "metadata":
        fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in nexus.RUN_FIELDS]))
        long = rows.select("base_name", fields.alias("c")).where("c.value IS NOT NULL")
        chosen = [F.lit("run"), F.col("c.field"), none, F.col("c.value"), nothing, nothing]
        rows = long
    elif name == "daslogs":
        device = F.concat("device_name", F.lit("/"), text("device_id"))
        chosen = [F.col("log_name"), F.lit("point"), F.coalesce("point_idx", none), device, number("time"), number("value")]
    elif name == "events":
        chosen = [F.col("bank"), F.lit("event"), F.col("event_idx"), text("event_id"), number("time_offset"), nothing]
    elif name == "event_summary":
        total = F.coalesce("total_counts", none).cast("string")
        chosen = [F.col("bank"), F.lit("bank"), F.col("n_pulses"), total, number("events_extracted"), nothing]
    else:
        chosen = [F.col("group"), F.col("field"), none, F.col("value"), nothing, nothing]
    names = ["grp", "field", "idx", "text", "num", "extra"]
    return rows.select(F.lit(name).alias("category"), "base_name", *[c.alias(n) for c, n in zip(chosen, names, strict=True)])


@query(f"WITH {CELLS_SQL} SELECT * REPLACE (idx::BIGINT AS idx) FROM cells")
def category_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node table to category files and back, cell by cell."""
    stored = scratch_path(spark, "nodes")
    write_nodes(run_nodes(spark, sf_dir).unionByName(event_nodes(spark, sf_dir)), stored)
    root = scratch_path(spark, "categories")
    written = write_categories(read_nodes(spark, stored), root, now=NOW)
    return reduce(DataFrame.unionByName, [_category_cells(spark, root, name) for name in written])


@query(f"WITH {CELLS_SQL} SELECT category, count(*) AS n_rows FROM cells WHERE category <> 'metadata' GROUP BY 1")
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per category as they were counted during the write."""
    stored = scratch_path(spark, "nodes")
    write_nodes(run_nodes(spark, sf_dir).unionByName(event_nodes(spark, sf_dir)), stored)
    written = write_categories(read_nodes(spark, stored), scratch_path(spark, "categories"), now=NOW)
    counts = [(name, n) for name, n in written.items() if name != "metadata"]
    return spark.createDataFrame(counts, "category string, n_rows bigint")
