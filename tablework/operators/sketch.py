"""Key sketches: which partitions of a table may hold a key, without reading the table.

Beside a table partitioned by one column lies a row per partition (per
``CHUNK_KEYS`` keys of it) with the number of its keys and a Bloom filter over
their hashes. The hashes of a merge source meet the sketches, not the keys of
the table; a partition whose filters know none of them holds none of them. A
false positive has a partition read in vain and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys of one filter, about.
CHUNK_KEYS = 1_000_000
#: Bits of a filter per key, and positions that a key sets: one in about 120 unknown keys passes.
BITS_PER_KEY, PROBES = 10, 7
#: Source keys up to which their hashes (8 bytes each) are broadcast to the sketches.
BROADCAST_KEYS = 1_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(hashes x PROBES) places in a filter of ``bits`` bits, by double hashing."""
    h = hashes.astype(np.int64).view(np.uint64)
    step = ((h >> np.uint64(31)) * _MIX) | np.uint64(1)
    probe = np.arange(PROBES, dtype=np.uint64)
    return ((h[:, None] + probe * step[:, None]) % np.uint64(bits)).astype(np.int64)


def bloom(hashes: np.ndarray) -> bytes:
    bits = max(64, len(hashes) * BITS_PER_KEY)
    held = np.zeros(bits, bool)
    held[positions(hashes, bits).ravel()] = True
    return np.packbits(held).tobytes() + bits.to_bytes(8, "little")


def knows_any(sketch: bytes, hashes: np.ndarray) -> bool:
    """Whether the filter may hold one of the hashes."""
    bits = int.from_bytes(sketch[-8:], "little")
    packed = np.frombuffer(sketch[:-8], np.uint8)
    for at in range(0, len(hashes), 100_000):
        place = positions(hashes[at : at + 100_000], bits)
        if ((packed[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).all(axis=1).any():
            return True
    return False


def _schema(partition: T.StructField) -> T.StructType:
    name = T.StructField("part", partition.dataType)
    return T.StructType([name, T.StructField("n", T.LongType()), T.StructField("bits", T.BinaryType()), T.StructField("slot", T.IntegerType())])


def _slot(column: str) -> Column:
    """The folder of a partition's sketches; few folders however many partitions there are."""
    return F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(64)).cast("int")


def sketches(rows: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """part, n, bits and slot for all rows; keys and partition are all that is read."""
    hashed = rows.select(F.col(partition).alias("part"), key_hash(keys).alias("hash"))
    counts = hashed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CHUNK_KEYS).alias("chunks"))
    placed = hashed.join(counts.withColumnRenamed("part", "of"), F.col("part").eqNullSafe(F.col("of"))).select(
        "part", F.pmod(F.col("hash"), F.col("chunks")).alias("chunk"), "hash"
    )

    def build(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": group["part"].iloc[:1], "n": [len(group)], "bits": [bloom(group["hash"].to_numpy())]})

    fields = _schema(rows.schema[partition]).fields[:3]
    built = placed.groupBy("part", "chunk").applyInPandas(build, T.StructType(fields))
    return built.withColumn("slot", _slot("part"))


def write_sketches(rows: DataFrame, path: str, keys: list[str], partition: str) -> None:
    """Sketches of a whole table."""
    sketches(rows, keys, partition).write.mode("errorifexists").partitionBy("slot").parquet(path)


def read_sketches(spark: SparkSession, path: str, partition: T.StructField) -> DataFrame:
    return spark.read.schema(_schema(partition)).parquet(path)


def renew_sketches(rows: DataFrame, path: str, keys: list[str], partition: str, touched: DataFrame) -> None:
    """Replace the sketches of the ``touched`` partitions by those of ``rows``, their present rows."""
    spark = rows.sparkSession
    listed = touched.select(F.col(partition).alias("of")).distinct()
    held = read_sketches(spark, path, rows.schema[partition])
    slots = [r[0] for r in listed.select(_slot("of")).distinct().collect()]
    others = held.where(F.col("slot").isin(slots)).join(listed, F.col("part").eqNullSafe(F.col("of")), "left_anti")
    (
        others.unionByName(sketches(rows, keys, partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("slot")
        .parquet(path)
    )


def may_hold(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition: str) -> DataFrame | None:
    """The partitions that may hold a key of ``source``; None when it has too many keys to broadcast."""
    hashes = source.select(key_hash(keys).alias("hash")).distinct().limit(BROADCAST_KEYS + 1).toArrow()
    if hashes.num_rows > BROADCAST_KEYS:
        return None
    field = source.schema[partition]
    shared = spark.sparkContext.broadcast(hashes.column("hash").to_numpy())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [i for i, bits in enumerate(batch.column("bits")) if knows_any(bits.as_py(), shared.value)]
            yield pa.RecordBatch.from_arrays([batch.column("part").take(pa.array(hit, pa.int64()))], names=["part"])

    found = read_sketches(spark, path, field).select("part", "bits").mapInArrow(look, T.StructType([T.StructField("part", field.dataType)]))
    return found.distinct().withColumnRenamed("part", partition)
