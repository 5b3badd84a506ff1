"""Session defaults, shared scratch space and the size checks behind broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Row bound under which a side may travel through the driver as a broadcast.
SMALL_ROWS = 10_000


def session(app_name: str = "tablework", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, ANSI, AQE)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tablework-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_rows(df: DataFrame, max_rows: int = SMALL_ROWS) -> list[Row] | None:
    """All rows of ``df`` when there are at most ``max_rows``, else ``None``."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcast after its size has been checked, else unchanged."""
    rows = small_rows(df, max_rows)
    if rows is None:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def hot_keys(
    df: DataFrame, keys: list[str], max_group: int, max_keys: int = SMALL_ROWS
) -> DataFrame | None:
    """Keys with more than ``max_group`` rows, or None without any.

    Counting is a pre-aggregated shuffle of the key columns only. Up to
    ``max_keys`` keys are a checked broadcast side; more are joined by shuffle.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    hot = cut_lineage(counts.where(F.col("__rows") > max_group).select(*keys))
    rows = small_rows(hot, max_keys)
    if rows is None:
        return hot
    if not rows:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.select(*keys).schema))
