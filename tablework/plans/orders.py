"""Order documents to landing files to the managed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.align import align
from tablework.operators.flatten import flatten_orders, status_distribution
from tablework.operators.upsert import newest_per_key, upsert, upsert_partitions
from tablework.operators.versions import append_batch, history
from tablework.schemas import ORDERS
from tablework.sinks.tables import with_day, write_landing
from tablework.sources.tables import read_documents, read_landing

KEY = ["OrderId"]


def newest_first() -> list[Column]:
    return [F.desc("SyncedAt"), F.desc("OrderDate")]


def sync_documents(spark: SparkSession, export: str, landing: str, now: str | None = None) -> None:
    """Flatten an export of documents into the day-partitioned landing zone."""
    write_landing(flatten_orders(read_documents(spark, export), now), landing)


def merged_orders(target: DataFrame, landed: DataFrame) -> DataFrame:
    """The managed table after a merge, as one lazy plan."""
    return upsert(target, align(landed, ORDERS), KEY, newest_first())


def merge_landing(spark: SparkSession, landing: str, table_path: str) -> list[str] | None:
    """Merge the landing zone into the managed table, rewriting touched days."""
    landed = read_landing(spark, landing)
    if landed is None:
        return None
    source = with_day(align(landed, ORDERS))
    return upsert_partitions(spark, table_path, source, KEY, "order_day", newest_first())


def commit_landing(
    spark: SparkSession, landing: str, path: str, commit_id: int, committed_at: str | None = None
) -> bool:
    """The same merge as a batch of changes, which keeps history and as-of reads."""
    landed = read_landing(spark, landing)
    if landed is None:
        return False
    append_batch(newest_per_key(align(landed, ORDERS), KEY, newest_first()), path, commit_id, committed_at)
    return True


def table_stats(orders: DataFrame, changes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Row count, status distribution and the five newest commits."""
    stats = {
        "rows": orders.agg(F.count(F.lit(1)).alias("cnt")),
        "status": status_distribution(orders),
    }
    if changes is not None:
        stats["snapshots"] = history(changes, KEY, last=5)
    return stats
