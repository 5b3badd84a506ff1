"""Row placement for partitioned writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.runtime import small_rows

#: Rows of one output partition that go to one file.
ROWS_PER_FILE = 5_000_000
#: Output partitions up to which their sizes are looked at one by one.
MAX_PARTITIONS = 100_000


def laid_out(
    df: DataFrame, partition: str, spread: list[str], rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Rows placed so that a write by ``partition`` makes few, bounded files.

    A count per output partition (one pruned, pre-aggregated pass) decides how
    many slots each one gets; ``spread`` names the columns whose hash chooses
    the slot. Small partitions stay whole and are written side by side, one
    with a third of all rows is cut into many slots, and the number of tasks
    grows with the data. Beyond ``MAX_PARTITIONS`` adaptive rebalancing decides.
    """
    counts = small_rows(df.groupBy(partition).agg(F.count(F.lit(1)).alias("n")), MAX_PARTITIONS)
    if counts is None:
        return df.hint("rebalance", partition)
    full = sum(row["n"] // rows_per_file for row in counts)
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), full)
    large = [(row[partition], -(-row["n"] // rows_per_file)) for row in counts if row["n"] > rows_per_file]
    if not large:
        return df.repartition(tasks, partition)
    kind = df.schema[partition].dataType.simpleString()
    slots = df.sparkSession.createDataFrame(large, f"__value {kind}, __slots bigint")
    slot = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("__slots")), F.lit(0))
    return (
        df.join(F.broadcast(slots), F.col(partition).eqNullSafe(F.col("__value")), "left")
        .repartition(tasks, F.col(partition), slot)
        .select(*df.columns)
    )
