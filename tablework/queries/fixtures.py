"""Operator inputs derived from the star-schema, event and document tables.

Each Spark function here has a SQL twin below it, used by the reference SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.times import floor_millis
from tablework.operators.numbering import number_within
from tablework.runtime import broadcast_if_small, hot_keys
from tablework.schemas import H5_NODES

NOW = "2024-01-01 00:00:00"
LATER = "2024-01-02 00:00:00"
LATEST = "2024-01-03 00:00:00"
#: Lines per document above which an order arrives in several documents.
LINES_PER_DOCUMENT = 1_000
#: Elements per stored chunk of a large dataset.
CHUNK = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def times_as_text(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that results compare across engines."""
    return df.select(
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t.startswith("timestamp") else F.col(c)
            for c, t in df.dtypes
        ]
    )


# --- flat orders ---------------------------------------------------------


def ship_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and country of every customer."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("ShipCity"), F.col("r_name").alias("ShipCountry"))
    )


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    orders = table(spark, sf_dir, "orders")
    return (
        orders.join(ship_to(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.concat(F.lit("orders/"), "o_orderkey").alias("OrderId"),
            F.concat(F.lit("customers/"), "o_custkey").alias("CustomerId"),
            F.col("o_orderdate").alias("OrderDate"),
            F.col("o_totalprice").alias("TotalAmount"),
            F.col("o_orderstatus").alias("Status"),
            "ShipCity",
            "ShipCountry",
            F.coalesce("n", F.lit(0)).cast("bigint").alias("LineCount"),
            ntz(NOW).alias("SyncedAt"),
        )
    )


LANDING_SQL = """
lines AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
landing AS (
  SELECT 'orders/' || o_orderkey AS "OrderId", 'customers/' || o_custkey AS "CustomerId",
         o_orderdate AS "OrderDate", o_totalprice AS "TotalAmount", o_orderstatus AS "Status",
         n_name AS "ShipCity", r_name AS "ShipCountry", coalesce(n, 0)::BIGINT AS "LineCount",
         TIMESTAMP '2024-01-01 00:00:00' AS "SyncedAt"
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN lines ON l_orderkey = o_orderkey)
"""


def changes(orders: DataFrame) -> DataFrame:
    """A merge source: pending orders change status, Asian ones are ordered again."""
    changed = orders.where("Status = 'P'").withColumn("Status", F.lit("X"))
    added = (
        orders.where("ShipCountry = 'ASIA'")
        .withColumn("OrderId", F.concat(F.lit("again/"), "OrderId"))
        .withColumn("Status", F.lit("N"))
    )
    return changed.unionByName(added).withColumn("SyncedAt", ntz(LATER))


def repeated_changes(orders: DataFrame) -> DataFrame:
    """The same with an older copy of every change."""
    stale = (
        changes(orders)
        .withColumn("Status", F.lit("S"))
        .withColumn("SyncedAt", ntz("2023-06-01 00:00:00"))
    )
    return changes(orders).unionByName(stale)


def later_changes(orders: DataFrame) -> DataFrame:
    return (
        orders.where("Status = 'F'")
        .withColumn("Status", F.lit("Y"))
        .withColumn("SyncedAt", ntz(LATEST))
    )


CHANGES_SQL = """
changes AS (
  SELECT * REPLACE ('X' AS "Status", TIMESTAMP '2024-01-02 00:00:00' AS "SyncedAt")
  FROM landing WHERE "Status" = 'P'
  UNION ALL
  SELECT * REPLACE ('again/' || "OrderId" AS "OrderId", 'N' AS "Status",
                    TIMESTAMP '2024-01-02 00:00:00' AS "SyncedAt")
  FROM landing WHERE "ShipCountry" = 'ASIA')
"""

ORDER_COLUMNS_SQL = """
  "OrderId", "CustomerId", strftime("OrderDate", '%Y-%m-%d %H:%M:%S') AS "OrderDate",
  "TotalAmount", "Status", "ShipCity", "ShipCountry", "LineCount",
  strftime("SyncedAt", '%Y-%m-%d %H:%M:%S') AS "SyncedAt"
"""


def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat orders from the event stream: few days, times within the day."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("events/"), "event_id").alias("OrderId"),
        F.concat(F.lit("customers/"), "user_id").alias("CustomerId"),
        floor_millis("ts").alias("OrderDate"),
        F.col("value").alias("TotalAmount"),
        F.col("event_type").alias("Status"),
        F.lit("").alias("ShipCity"),
        F.lit("").alias("ShipCountry"),
        F.lit(1).cast("bigint").alias("LineCount"),
        ntz(NOW).alias("SyncedAt"),
    )


EVENT_ORDERS_SQL = """
flat AS (
  SELECT 'events/' || event_id AS "OrderId", 'customers/' || user_id AS "CustomerId",
         date_trunc('milliseconds', ts) AS "OrderDate", value AS "TotalAmount",
         event_type AS "Status", '' AS "ShipCity", '' AS "ShipCountry", 1::BIGINT AS "LineCount",
         TIMESTAMP '2024-01-01 00:00:00' AS "SyncedAt"
  FROM events)
"""


# --- order documents -----------------------------------------------------


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents; an order with very many lines is split over several.

    Urgent orders carry no amount and high-priority ones a zero, so both are
    recomputed from their lines.
    """
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_quantity"
    )
    line = F.struct(
        F.col("l_partkey").cast("string").alias("ProductName"),
        F.col("l_extendedprice").alias("Price"),
        F.col("l_quantity").cast("int").alias("Quantity"),
    )

    def gathered(rows: DataFrame) -> DataFrame:
        lines = F.array_sort(F.collect_list(line)).alias("Lines")
        return rows.groupBy("l_orderkey", "part").agg(lines)

    headers = table(spark, sf_dir, "orders").join(
        ship_to(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")
    )
    same = F.col("o_orderkey") == F.col("l_orderkey")
    hot = hot_keys(lineitem, ["l_orderkey"], LINES_PER_DOCUMENT)
    if hot is None:
        nested = headers.join(gathered(lineitem.withColumn("part", F.lit(0))), same, "left")
    else:
        # Few orders are large, so their headers go to the lines, not the lines to them.
        spread = F.floor(F.monotonically_increasing_id() / LINES_PER_DOCUMENT)
        parts = lineitem.withColumn("part", spread)
        large = gathered(parts.join(hot, "l_orderkey", "left_semi"))
        rest = gathered(parts.join(hot, "l_orderkey", "left_anti").withColumn("part", F.lit(0)))
        own = F.broadcast(headers.join(hot, same, "left_semi"))
        nested = (
            headers.join(hot, same, "left_anti")
            .join(rest, same, "left")
            .unionByName(large.join(own, same), allowMissingColumns=True)
        )
    priority = F.col("o_orderpriority")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return nested.select(
        F.concat(F.lit("orders/"), "o_orderkey").alias("id"),
        F.concat(F.lit("customers/"), "o_custkey").alias("CustomerId"),
        F.when(priority == "3-MEDIUM", iso).otherwise(F.concat(iso, F.lit("Z"))).alias("OrderDate"),
        F.lit(None).cast("string").alias("RequiredDate"),
        F.lit(None).cast("string").alias("ShippedDate"),
        F.col("o_orderstatus").alias("Status"),
        "Lines",
        F.when(priority == "1-URGENT", F.lit(None))
        .when(priority == "2-HIGH", F.lit(0.0))
        .otherwise(F.col("o_totalprice"))
        .cast("double")
        .alias("TotalAmount"),
        F.struct(F.col("ShipCity").alias("City"), F.col("ShipCountry").alias("Country")).alias("ShipTo"),
        priority.alias("Notes"),
    )


def discounted_documents(spark: SparkSession, sf_dir: str, whole: bool = True) -> DataFrame:
    """Documents without an amount whose prices carry up to four decimals.

    One row per order, or one numbered part per line. An order has few lines.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.struct(
            F.col("l_partkey").cast("string").alias("ProductName"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("Price"),
            F.col("l_quantity").cast("int").alias("Quantity"),
        ).alias("line"),
    )
    if whole:
        parts = lines.groupBy("l_orderkey").agg(F.lit(0).alias("Part"), F.collect_list("line").alias("Lines"))
    else:
        parts = lines.select("l_orderkey", F.col("l_linenumber").alias("Part"), F.array("line").alias("Lines"))
    orders = table(spark, sf_dir, "orders").join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return orders.select(
        F.concat(F.lit("orders/"), "o_orderkey").alias("id"),
        F.concat(F.lit("customers/"), "o_custkey").alias("CustomerId"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("OrderDate"),
        F.col("o_orderstatus").alias("Status"),
        "Lines",
        F.lit(None).cast("double").alias("TotalAmount"),
        F.struct(F.lit("").alias("City"), F.lit("").alias("Country")).alias("ShipTo"),
        "Part",
    )


FLAT_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n,
         sum(l_extendedprice::DECIMAL(18,2) * l_quantity::DECIMAL(10,0)) AS total
  FROM lineitem GROUP BY l_orderkey),
flat AS (
  SELECT 'orders/' || o_orderkey AS "OrderId", 'customers/' || o_custkey AS "CustomerId",
         o_orderdate AS "OrderDate",
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN coalesce(total, 0)::DOUBLE
              ELSE o_totalprice END AS "TotalAmount",
         o_orderstatus AS "Status", n_name AS "ShipCity", r_name AS "ShipCountry",
         coalesce(n, 0)::BIGINT AS "LineCount", TIMESTAMP '2024-01-01 00:00:00' AS "SyncedAt"
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN lines ON l_orderkey = o_orderkey)
"""


# --- file metadata -------------------------------------------------------


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First vintage: loosely typed, some columns missing."""
    return table(spark, sf_dir, "documents").selectExpr(
        """'/bronze/hdf5/' || source || '/doc-' || doc_id || CASE lang WHEN 'en' THEN '.nxs.h5'
             WHEN 'fr' THEN '.hdf5' WHEN 'de' THEN '.H5' ELSE '.txt' END AS file_path""",
        "source || '.nxs.h5' AS file_name",
        "n_chars AS file_size_bytes",
        "'2024-01-02T08:00:00' AS ingestion_time",
        "CASE WHEN n_chars >= 200 THEN '3' END AS group_count",
        "lang || ' ' || source AS title",
        "'2023-05-' || lpad(CAST(n_chars % 28 + 1 AS STRING), 2, '0') || 'T00:00:00' AS start_time",
        "CASE source WHEN 'src17' THEN '[1.0, 2.0]' ELSE n_chars || '.5' END AS duration",
        "CASE source WHEN 'src11' THEN '' WHEN 'src13' THEN NULL ELSE lang END AS instrument_name",
        "CASE WHEN lang = 'de' THEN 's3://bucket/' || doc_id WHEN lang = 'fr' THEN '' "
        "WHEN lang = 'en' THEN '/bronze/' || doc_id END AS tiled_uri",
        "CASE WHEN n_chars < 200 THEN 'truncated file' END AS extraction_error",
    )


METADATA_SQL = """
meta AS (
  SELECT '/bronze/hdf5/' || source || '/doc-' || doc_id || CASE lang WHEN 'en' THEN '.nxs.h5'
           WHEN 'fr' THEN '.hdf5' WHEN 'de' THEN '.H5' ELSE '.txt' END AS file_path,
         source || '.nxs.h5' AS file_name,
         n_chars AS file_size_bytes,
         '2024-01-02T08:00:00' AS ingestion_time,
         CASE WHEN n_chars >= 200 THEN '3' END AS group_count,
         lang || ' ' || source AS title,
         '2023-05-' || lpad(CAST(n_chars % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00' AS start_time,
         CASE source WHEN 'src17' THEN '[1.0, 2.0]' ELSE n_chars || '.5' END AS duration,
         CASE source WHEN 'src11' THEN '' WHEN 'src13' THEN NULL ELSE lang END AS instrument_name,
         CASE WHEN lang = 'de' THEN 's3://bucket/' || doc_id WHEN lang = 'fr' THEN ''
              WHEN lang = 'en' THEN '/bronze/' || doc_id END AS tiled_uri,
         CASE WHEN n_chars < 200 THEN 'truncated file' END AS extraction_error
  FROM documents)
"""


def second_vintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later ingests of the labelled files: sizes as text, a stale copy of the toxic ones."""
    documents = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    rows = documents.selectExpr(
        """'/bronze/hdf5/' || source || '/doc-' || doc_id || CASE lang WHEN 'en' THEN '.nxs.h5'
             WHEN 'fr' THEN '.hdf5' WHEN 'de' THEN '.H5' ELSE '.txt' END AS file_path""",
        "source || '.nxs.h5' AS file_name",
        "CAST(n_chars AS STRING) AS file_size_bytes",
        "'2024-01-03T08:00:00' AS ingestion_time",
        "'quality ' || quality AS title",
        "CAST(quality AS DOUBLE) AS duration",
        "lang AS instrument_name",
        "toxic",
    )
    stale = rows.where("toxic = 1").withColumns(
        {"ingestion_time": F.lit("2024-01-02T20:00:00"), "title": F.lit("stale")}
    )
    return rows.unionByName(stale).drop("toxic")


SECOND_VINTAGE_SQL = """
second AS (
  SELECT '/bronze/hdf5/' || source || '/doc-' || doc_id || CASE lang WHEN 'en' THEN '.nxs.h5'
           WHEN 'fr' THEN '.hdf5' WHEN 'de' THEN '.H5' ELSE '.txt' END AS file_path,
         source || '.nxs.h5' AS file_name, n_chars AS file_size_bytes, '2024-01-03T08:00:00' AS ingestion_time,
         'quality ' || quality AS title, quality::DOUBLE AS duration,
         lang AS instrument_name, toxic
  FROM documents JOIN labels USING (doc_id))
"""


# --- node table ----------------------------------------------------------

_G, _D = "group", "dataset"

#: Layout of one run file per supplier: path, kind, class, value column, value,
#: condition. Values are Spark and DuckDB expressions alike.
RUN_FILE = [
    ("entry", _G, "NXentry", None, None, None),
    ("entry/Software", _G, "NXcollection", None, None, None),
    ("entry/Software/reducer", _G, "NXprocess", None, None, None),
    ("entry/Software/reducer/authors", _D, None, "str", "'Ada', 'Grace'", None),
    ("entry/Software/reducer/version", _D, None, "str", "'v' || s_nationkey", None),
    ("entry/Software/writer", _G, "NXprocess", None, None, None),
    ("entry/Software/writer/version", _D, None, "str", "'w1'", None),
    ("entry/duration", _D, None, "dbl", "s_acctbal", None),
    ("entry/experiment_identifier", _D, None, "str", "'IPTS-' || s_suppkey", "s_acctbal >= 1000"),
    ("entry/instrument", _G, "NXinstrument", None, None, None),
    ("entry/instrument/beamline", _D, None, "int", "s_nationkey", None),
    ("entry/instrument/instrument_xml", _G, "NXnote", None, None, None),
    ("entry/instrument/instrument_xml/data", _D, None, "str", "'<xml/>'", None),
    ("entry/instrument/moderator", _G, "NXsource", None, None, None),
    ("entry/instrument/moderator/name", _D, None, "str", "'moderator'", None),
    ("entry/instrument/name", _D, None, "str", "'INST_' || s_nationkey", None),
    ("entry/instrument/source", _G, "NXsource", None, None, None),
    ("entry/instrument/source/name", _D, None, "str", "'source ' || s_nationkey", None),
    ("entry/instrument/source/type", _D, None, "str", "'pulsed'", None),
    ("entry/run_number", _D, None, "int", "s_suppkey", None),
    ("entry/sample", _G, "NXsample", None, None, "s_acctbal >= 0"),
    ("entry/sample/description", _D, None, "str", "'sample of ' || s_name", "s_acctbal >= 0"),
    ("entry/sample/mass", _D, None, "dbl", "s_acctbal", "s_acctbal >= 0"),
    ("entry/sample/name", _D, None, "str", "s_name", "s_acctbal >= 0"),
    ("entry/start_time", _D, None, "str", "'2024-01-01T00:00:00'", None),
    ("entry/title", _D, None, "str", "'run of ' || s_name", None),
    ("entry/user", _G, "NXuser", None, None, None),
    ("entry/user/facility_user_id", _D, None, "str", "'u' || s_nationkey", None),
    ("entry/user/name", _D, None, "str", "'user ' || s_nationkey", None),
    ("entry/user1", _G, "NXuser", None, None, None),
    ("entry/user1/role", _D, None, "str", "'', 'local contact', ''", None),
    ("entry2", _G, "NXentry", None, None, None),
    ("entry2/title", _D, None, "str", "'second entry'", None),
]
#: Count arrays below the second entry; their sizes straddle the limit of 100.
COUNT_ARRAYS = 40
#: Run files that one task unfolds.
RUNS_PER_TASK = 1_000


def _count_array_size(number: str) -> str:
    return f"(85 + {number} + s_nationkey)"


def run_file_path() -> Column:
    return F.concat(F.lit("/runs/run-"), F.col("s_suppkey"), F.lit(".nxs.h5"))


def run_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node rows of one file per supplier; built inside each supplier's row."""
    null = "CAST(NULL AS {})".format
    text, longs, doubles = "array<string>", "array<bigint>", "array<double>"

    def node(order, path, kind, nx_class, column, value, condition, size="0", dtype=""):
        values = {
            c: f"CAST({value} AS {t})" if c == column else null(t)
            for c, t in (("str", text), ("int", longs), ("dbl", doubles))
        }
        attrs = f"map('NX_class', '{nx_class}')" if nx_class else "CAST(map() AS map<string,string>)"
        row = (
            f"named_struct('node_path', '{path}', 'visit_order', {order}, 'kind', '{kind}',"
            f" 'attrs', {attrs}, 'dtype', '{dtype}', 'size', CAST({size} AS bigint),"
            f" 'str_values', {values['str']}, 'int_values', {values['int']},"
            f" 'dbl_values', {values['dbl']})"
        )
        return f"CASE WHEN {condition} THEN {row} END" if condition else row

    rows = [
        "named_struct('node_path', '', 'visit_order', 0, 'kind', 'file',"
        " 'attrs', map('driver', 'sec2', 'libver', 'v110', 'file_name', 'run-' || s_suppkey),"
        " 'dtype', '', 'size', CAST(0 AS bigint), 'str_values', CAST(NULL AS array<string>),"
        " 'int_values', CAST(NULL AS array<bigint>), 'dbl_values', CAST(NULL AS array<double>))"
    ]
    for order, (path, kind, nx_class, column, value, condition) in enumerate(RUN_FILE, start=1):
        size, array = "0", None
        if kind == _D:
            array = f"array({value})"
            size = f"size({array})"
        rows.append(node(order, path, kind, nx_class, column, array, condition, size, column or ""))
    for number in range(COUNT_ARRAYS):
        size = _count_array_size(str(number))
        rows.append(
            node(
                100 + number, f"entry2/counts{number:02d}", _D, None, "int",
                f"array_repeat(s_suppkey, {size})", None, size, "int",
            )
        )
    # A small file is one task's, whatever its rows unfold to.
    suppliers = table(spark, sf_dir, "supplier")
    suppliers = suppliers.repartition(suppliers.count() // RUNS_PER_TASK + 1)
    exploded = suppliers.select(
        run_file_path().alias("file_path"), F.explode(F.expr(f"array({', '.join(rows)})")).alias("n")
    )
    return _complete(exploded.where("n IS NOT NULL").select("file_path", "n.*", F.lit(0).alias("chunk_offset")))


def _complete(nodes: DataFrame) -> DataFrame:
    """Derive parent, name, depth and shape, and bring all columns into order."""
    path = F.col("node_path")
    return (
        nodes.withColumn("parent_path", F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(""))
        .withColumn("name", F.substring_index(path, "/", -1))
        .withColumn("depth", F.when(path == "", 0).otherwise(F.size(F.split(path, "/"))))
        .withColumn("shape", F.when(F.col("kind") == "dataset", F.array("size")))
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in H5_NODES])
    )


def _values_sql(rows) -> str:
    return ", ".join("(" + ", ".join(rows_) + ")" for rows_ in rows)


#: The same layout as a relation of (path, kind, order, size, keep) per supplier.
RUN_NODES_SQL = (
    "nodes AS (SELECT '/runs/run-' || s_suppkey || '.nxs.h5' AS file_path, t.* FROM supplier, LATERAL (VALUES "
    + _values_sql(
        [
            (f"'{p}'", f"'{k}'", str(i), "1", c or "true")
            for i, (p, k, _, _, _, c) in enumerate(RUN_FILE, start=1)
        ]
        + [
            (f"'entry2/counts{n:02d}'", "'dataset'", str(100 + n), _count_array_size(str(n)), "true")
            for n in range(COUNT_ARRAYS)
        ]
    )
    + ") AS t(path, kind, visit_order, size, keep) WHERE keep)"
)

EVENT_FILE = "/runs/events.nxs.h5"
#: Values of this log stop early, so times outnumber them.
SHORT_LOG, SHORT_UNTIL = "error", "2024-01-29 00:00:00"
#: This log has pulse times only.
PULSE_LOG = "purchase"


def event_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run file with a log and a detector bank per event type.

    Positions come from the numbering operator, which splits hot event types;
    arrays hold at most one chunk.
    """
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    events = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "user_id", "value")
    numbered = number_within(events, ["event_type"], ["ts", "event_id"], "idx")
    seconds = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(start)) / F.lit(1e6)
    point = F.struct(
        "idx",
        seconds.alias("t"),
        F.col("value").alias("v"),
        F.col("user_id").alias("u"),
        ((F.col("event_type") != SHORT_LOG) | (F.col("ts") < ntz(SHORT_UNTIL))).alias("kept"),
    )
    chunks = (
        numbered.withColumn("chunk_offset", F.col("idx") - F.col("idx") % CHUNK)
        .groupBy("event_type", "chunk_offset")
        .agg(F.array_sort(F.collect_list(point)).alias("p"))
    )
    facts = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("event_type") != SHORT_LOG) | (F.col("ts") < ntz(SHORT_UNTIL))).alias("n_values"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )
    # First position of every day; a row per event type, an element per calendar day.
    pulses = (
        numbered.groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.min("idx").alias("first"))
        .groupBy("event_type")
        .agg(F.array_sort(F.collect_list("first")).alias("index"))
    )

    log = F.concat(F.lit("entry/DASlogs/"), F.col("event_type"))
    bank = F.concat(F.lit("entry/"), F.col("event_type"), F.lit("_events"))
    is_pulse = F.col("event_type") == PULSE_LOG
    values = F.filter("p", lambda x: x["kept"])["v"]
    series = F.array(
        F.when(~is_pulse, _dataset(F.concat(log, F.lit("/time")), F.col("n"), dbl=F.col("p.t"))),
        F.when(
            ~is_pulse & (F.size(values) > 0),
            _dataset(F.concat(log, F.lit("/value")), F.col("n_values"), dbl=values),
        ),
        F.when(is_pulse, _dataset(F.concat(log, F.lit("/veto_pulse_time")), F.col("n"), dbl=F.col("p.t"))),
        _dataset(F.concat(bank, F.lit("/event_id")), F.col("n"), int_=F.col("p.u")),
        _dataset(F.concat(bank, F.lit("/event_time_offset")), F.col("n"), dbl=F.col("p.v")),
        F.when(is_pulse, _dataset(F.lit("entry/monitor1/event_id"), F.col("n"), int_=F.col("p.u"))),
    )
    bulk = chunks.join(broadcast_if_small(facts), "event_type").select("chunk_offset", F.explode(series).alias("node"))

    scalars = F.array(
        _group(log, "NXlog"),
        _group(bank, "NXevent_data"),
        _dataset(F.concat(log, F.lit("/device_name")), F.lit(1), str_=F.array(F.concat(F.lit("dev-"), "event_type"))),
        _dataset(F.concat(log, F.lit("/device_id")), F.lit(1), int_=F.array(F.length("event_type").cast("bigint"))),
        _dataset(F.concat(log, F.lit("/minimum_value")), F.lit(1), dbl=F.array("lowest")),
        _dataset(F.concat(log, F.lit("/maximum_value")), F.lit(1), dbl=F.array("highest")),
        _dataset(F.concat(bank, F.lit("/total_counts")), F.lit(1), int_=F.array("n")),
        _dataset(F.concat(bank, F.lit("/event_index")), F.size("index"), int_=F.col("index")),
    )
    small = facts.join(pulses, "event_type").select(F.lit(0).alias("chunk_offset"), F.explode(scalars).alias("node"))

    # Structure that exists once: the root, an idle log and an empty bank.
    empty = F.array().cast("array<bigint>")
    fixed = table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("chunk_offset"),
        F.explode(
            F.array(
                _group(F.lit("entry"), "NXentry"),
                _group(F.lit("entry/DASlogs"), "NXcollection"),
                _group(F.lit("entry/DASlogs/idle"), "NXlog"),
                _dataset(F.lit("entry/DASlogs/idle/device_name"), F.lit(1), str_=F.array(F.lit("nothing"))),
                _group(F.lit("entry/monitor1"), "NXmonitor"),
                _group(F.lit("entry/empty_events"), "NXevent_data"),
                _dataset(F.lit("entry/empty_events/event_id"), F.lit(0), int_=empty),
                _dataset(F.lit("entry/empty_events/event_time_offset"), F.lit(0), int_=empty),
                _dataset(F.lit("entry/title"), F.lit(1), str_=F.array(F.lit("event run"))),
                _dataset(F.lit("entry/total_counts"), F.lit(1), int_=F.array("n")),
            )
        ).alias("node"),
    )
    nodes = bulk.unionByName(small).unionByName(fixed).where("node IS NOT NULL")
    return _complete(nodes.select(F.lit(EVENT_FILE).alias("file_path"), "chunk_offset", "node.*"))


def _node(path: Column, kind: str, attrs: Column, size: Column, str_, int_, dbl) -> Column:
    def typed(value, kind_):
        return (F.lit(None) if value is None else value).cast(kind_)

    return F.struct(
        path.alias("node_path"),
        F.lit(0).alias("visit_order"),
        F.lit(kind).alias("kind"),
        attrs.alias("attrs"),
        F.lit("").alias("dtype"),
        size.cast("bigint").alias("size"),
        typed(str_, "array<string>").alias("str_values"),
        typed(int_, "array<bigint>").alias("int_values"),
        typed(dbl, "array<double>").alias("dbl_values"),
    )


def _dataset(path: Column, size: Column, str_=None, int_=None, dbl=None) -> Column:
    return _node(path, "dataset", F.create_map().cast("map<string,string>"), size, str_, int_, dbl)


def _group(path: Column, nx_class: str) -> Column:
    attrs = F.create_map(F.lit("NX_class"), F.lit(nx_class))
    return _node(path, "group", attrs, F.lit(0), None, None, None)


EVENTS_SQL = f"""
numbered AS (
  SELECT event_type, ts, user_id, value,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS idx,
         (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1e6 AS t,
         (event_type <> '{SHORT_LOG}' OR ts < TIMESTAMP '{SHORT_UNTIL}') AS kept
  FROM events),
facts AS (
  SELECT event_type, count(*) AS n, min(value) AS lowest, max(value) AS highest,
         count(DISTINCT ts::DATE) AS days
  FROM events GROUP BY event_type)
"""


# --- vectors -------------------------------------------------------------


def label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: its newest vector."""
    return (
        table(spark, sf_dir, "embeddings")
        .groupBy(F.col("label").cast("bigint").alias("query_id"))
        .agg(F.max_by("embedding", "vec_id").alias("vector"))
    )


def label_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell centre per label: its oldest vector."""
    return (
        table(spark, sf_dir, "embeddings")
        .groupBy(F.col("label").cast("bigint").alias("centre"))
        .agg(F.min_by("embedding", "vec_id").alias("vector"))
    )


VECTOR_SQL = """
q AS (SELECT label::BIGINT AS query_id, arg_max(embedding, vec_id)::DOUBLE[] AS qv
      FROM embeddings GROUP BY label),
c AS (SELECT row_number() OVER (ORDER BY label) - 1 AS cell, v AS cv FROM
      (SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS v FROM embeddings GROUP BY label)),
e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS ev FROM embeddings)
"""
