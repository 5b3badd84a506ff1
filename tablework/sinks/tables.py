"""Tables, landing files, vectors, nodes and category files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablework.functions.paths import output_base_name
from tablework.functions.times import day_key
from tablework.operators import nexus
from tablework.operators.publish import stage
from tablework.operators.registry import new_only
from tablework.operators.similarity import require_collection
from tablework.operators.upsert import partition_key
from tablework.schemas import FILE_REGISTRY, H5_CATALOG, ORDERS
from tablework.sinks.layout import laid_out


# Categories whose tables hold fields.
FIELD_CATEGORIES = ("sample", "instrument", "users", "software")


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition: str | None = None,
    location: str | None = None,
) -> None:
    """Create a Parquet table unless it exists."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partition:
        ddl += f" PARTITIONED BY ({partition})"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


def create_orders_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Orders by day; the day is a derived column, filled by `with_day`."""
    schema = StructType([*ORDERS, StructField("order_day", StringType())])
    create_table(spark, name, schema, "order_day", location)


def create_catalog_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The catalog by instrument; an empty instrument is read as NULL from its partition."""
    create_table(spark, name, H5_CATALOG, "instrument_name", location)


def create_keyed_catalog_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The catalog by instrument key, a derived column that `with_instrument` fills; keeps NULL and empty apart."""
    schema = StructType([*H5_CATALOG, StructField("instrument_key", StringType())])
    create_table(spark, name, schema, "instrument_key", location)


def create_registry_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    create_table(spark, name, FILE_REGISTRY, None, location)


def with_day(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_day", day_key("OrderDate"))


def with_instrument(catalog: DataFrame) -> DataFrame:
    return catalog.withColumn("instrument_key", partition_key("instrument_name"))


def append(df: DataFrame, table: str, mode: str = "append") -> None:
    """Append to a table by column name; ``new_only`` skips registered paths."""
    if mode == "new_only":
        df = new_only(df, df.sparkSession.table(table))
    target = df.sparkSession.table(table).columns
    df.select(*target).write.insertInto(table)


def write_landing(orders: DataFrame, root: str) -> None:
    """One folder per day; a day that is written again replaces that day only."""
    (
        laid_out(with_day(orders), "order_day", ["OrderId"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("order_day")
        .parquet(root)
    )


def write_snapshot(metadata: DataFrame, root: str, stamp: str) -> str:
    """A stamped metadata snapshot beside the earlier ones."""
    path = f"{root.rstrip('/')}/hdf5_metadata_{stamp}"
    metadata.write.mode("errorifexists").option("compression", "snappy").parquet(path)
    return path


def write_vectors(vectors: DataFrame, first: str, second: str) -> None:
    """The vector table at two destinations; the second is copied from the first."""
    vectors.select("id", "order_id", "vector").write.mode("overwrite").parquet(first)
    copy = vectors.sparkSession.read.schema(vectors.select("id", "order_id", "vector").schema)
    copy.parquet(first).write.mode("overwrite").parquet(second)


def write_collection(vectors: DataFrame, path: str, dim: int) -> int:
    """Replace a collection after checking its rows; returns the entity count.

    Rows with a ``cell`` are stored by cell, so a search reads probed cells only.
    The rows are staged first: checks, layout and write don't compute them anew.
    """
    vectors = stage(vectors.sparkSession, vectors)
    count = require_collection(vectors, dim)
    if "cell" in vectors.columns:
        placed = laid_out(vectors, "cell", ["id"])
        placed.write.mode("overwrite").partitionBy("cell").parquet(path)
    else:
        vectors.write.mode("overwrite").parquet(path)
    return count


def write_nodes(nodes: DataFrame, path: str, bulk_size: int = 1_000) -> None:
    """Node table with large datasets in a partition of their own.

    Readers of scalars then never touch event or log arrays, and sorting by
    name lets the remaining scans skip pages of other datasets.
    """
    (
        nodes.withColumn("bulk", F.coalesce(F.col("size") > bulk_size, F.lit(False)))
        .sortWithinPartitions("bulk", "name", "file_path", "chunk_offset")
        .write.mode("errorifexists")
        .partitionBy("bulk")
        .parquet(path)
    )


def write_node_table(
    nodes: DataFrame, table: str, buckets: int, location: str | None = None, bulk_size: int = 1_000
) -> None:
    """The same as a table bucketed by chunk position, with parallel datasets aligned.

    The two chunks of a position then lie in one bucket, and logs and events
    unfold without a shuffle of their arrays. One shuffle here replaces one in
    every later read.
    """
    keys = ["file_path", "parent_path", "chunk_offset"]
    placed = nexus.aligned(nodes).withColumn("bulk", F.coalesce(F.col("size") > bulk_size, F.lit(False)))
    writer = (
        placed.repartition(buckets, *keys)
        .write.mode("errorifexists")
        .format("parquet")
        .partitionBy("bulk")
        .bucketBy(buckets, *keys)
    )
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def write_categories(
    nodes: DataFrame,
    root: str,
    entry: str = "entry",
    max_events: int | None = None,
    include_events: bool = True,
    now: str | None = None,
) -> dict[str, int]:
    """Category tables of a set of files; returns the rows of each one that has any.

    The nodes are scanned three times: once for everything small, which is
    staged and serves the fields, the run metadata, the heads of logs and the
    summary of banks, once for the points of logs and once for events. Fields
    are tagged with their category and written by it in one pass. Rows are
    counted while they are written.

    Rows lead with the base name of their file and are sorted by it, so a
    reader of one file skips the row groups of the others; a folder per file
    would not survive a million files. Events are partitioned by bank, and a
    large bank is split by adaptive rebalancing. Read a table with
    :func:`~tablework.sources.tables.read_category`.
    """
    spark = nodes.sparkSession
    base = output_base_name("file_path").alias("base_name")
    small = stage(spark, nexus.small_nodes(nodes, entry))
    counted: dict[str, int] = {}

    def save(rows: DataFrame, folder: str, names: list[str], partition: str | None = None) -> None:
        seen = Observation()
        tag = F.col(partition) if len(names) > 1 else F.lit(names[0])
        watched = rows.observe(seen, *[F.count_if(tag == name).alias(name) for name in names])
        writer = watched.write.mode("errorifexists")
        (writer.partitionBy(partition) if partition else writer).parquet(f"{root.rstrip('/')}/{folder}")
        counted.update({name: n for name, n in seen.get.items() if n})

    fields = nexus.category_fields(small, entry)
    placed = fields.select("category", base, *[c for c in fields.columns if c != "category"])
    save(placed.sortWithinPartitions("category", "base_name"), "fields", list(FIELD_CATEGORIES), "category")
    run = nexus.run_metadata(small, entry, now).withColumn("file_path", F.col("source_path"))
    metadata = run.select(base, *[c for c in run.columns if c != "file_path"])
    save(metadata.sortWithinPartitions("base_name"), "metadata", ["metadata"])
    logs = nexus.daslog_rows(nodes, entry, heads=nexus.log_heads(small, entry))
    save(logs.select(base, *logs.columns).sortWithinPartitions("base_name"), "daslogs", ["daslogs"])
    if include_events:
        events = nexus.event_rows(nodes, entry, max_events)
        by_bank = events.select(base, *events.columns).hint("rebalance", "bank").sortWithinPartitions("bank", "base_name")
        save(by_bank, "events", ["events"], "bank")
        banks = nexus.bank_summary(small, entry, max_events)
        save(banks.select(base, *banks.columns).sortWithinPartitions("base_name"), "event_summary", ["event_summary"])
    return counted


def write_manifest(entries: DataFrame, path: str) -> None:
    entries.write.mode("errorifexists").json(path)
