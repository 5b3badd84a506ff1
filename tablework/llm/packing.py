"""Packing token pieces into sequences: shortest-pack-first over the length histogram.

Documents are cut into pieces of at most ``size`` ids. The histogram of piece
lengths, at most ``size`` rows whatever the input, is packed on the driver:
lengths are placed longest first, each into the shortest pack it fits, and packs
of one pattern are kept as one entry with a count, so the work depends on the
histogram and not on the number of documents. Every placement is a range of
ranks within a length; pieces join it by their rank.

A piece gets its rank from a salted numbering: rows of one length are spread
over salts, so a length that a third of all pieces have is never numbered in one
task. A null text is an empty text and holds only the closing id. Repeated
documents are packed as often as they appear; no documents give no sequences. A
very long text is cut into as many pieces as it needs. Other columns of the
input, whatever their names, are not read. Sequences are padded to ``size``
unless their length is a power of two.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm import bpe
from tablework.runtime import cut_lineage

SIZE = 4096
#: Pieces per salt of the numbering, on average.
SALT_ROWS = 20_000


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, number, first sequence, offset).

    Packs are entries (filled, first sequence, number); a placement takes as
    many packs of the shortest entry as there are pieces left.
    """
    packs: list[tuple[int, int, int]] = []
    placed: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            if packs and packs[0][0] + length <= size:
                filled, first, number = heapq.heappop(packs)
                taken = min(left, number)
                placed.append((length, rank, taken, first, filled))
                if number > taken:
                    heapq.heappush(packs, (filled, first + taken, number - taken))
                heapq.heappush(packs, (filled + length, first, taken))
                left -= taken
                rank += taken
                continue
            # Nothing fits: new packs, each filled with this length before the next is opened.
            fit = min(size // length, left)
            number = left // fit
            for slot in range(fit):
                placed.append((length, rank, number, sequences, slot * length))
                rank += number
            heapq.heappush(packs, (fit * length, sequences, number))
            sequences += number
            left -= fit * number
    return placed


def ranked(pieces: DataFrame, salts: int) -> DataFrame:
    """``pieces`` with ``rank``, 0-based within each length."""
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    sizes = salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col("length").alias("__length"),
        F.col("__salt").alias("__of"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__shift"),
    )
    within = Window.partitionBy("length", "__salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = salted.withColumn("__nth", F.row_number().over(within).cast("long") - 1)
    return numbered.join(
        shifts, (F.col("length") == F.col("__length")) & (F.col("__salt") == F.col("__of"))
    ).select(*pieces.columns, (F.col("__nth") + F.col("__shift")).alias("rank"))


def place(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` with sequence_id and offset. ``pieces`` must not change between reads."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed = sorted(pack_histogram(counts, size))
    keys = np.array([(p[0] << 44) + p[1] for p in placed], np.int64)
    shift = np.array([p[3] - p[1] for p in placed], np.int64)
    filled = np.array([p[4] for p in placed], np.int64)
    salts = max(1, sum(counts.values()) // SALT_ROWS)
    names = pieces.columns
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 44) + rank, "right") - 1
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(rank + shift[at]), pa.array(filled[at])],
                names=[*names, "sequence_id", "offset"],
            )

    return ranked(pieces, salts).mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, size: int = SIZE, text: str = "text", path: str | None = None, end_id: int = 2
) -> DataFrame:
    """Pieces of all documents with their sequence; the ids are made once and kept only as digests."""
    return place(cut_lineage(bpe.pieces(docs, size, text, path, end_id)), size)
