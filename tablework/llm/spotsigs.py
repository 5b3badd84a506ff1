"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

A text's words are lowered and stripped of punctuation. Anchors are common words
of several languages; after each anchor the next ``CHAIN`` content words (neither
anchors nor one-letter words) form a signature together with the anchor. In
stretches without anchors, a word that has no anchor among the ``GAP`` words
before it is an anchor itself, so lists and short texts have signatures too; a
chain that the text's end cuts short counts as it is. A fingerprint is the set of
signatures, written as sorted 32-bit hashes in hex.

Likeness is the Jaccard similarity of two signature sets. Sets are compared by
partition of set length: ``lengths_apart`` tells from the lengths alone that a
similarity can't be reached, and an intersection is abandoned as soon as the
missing signatures rule it out.

A null text is an empty text; texts without words have the empty fingerprint.
Equal fingerprints have likeness 1 (two empty ones too), an empty and a non-empty
one 0. Rows that share an id are taken in the order of their text, and repeated
rows follow each other. With a single row the next document is the row itself.
Very long texts are read whole, an empty table gives no rows, and other columns
of the input, whatever their names, are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm import words as W

CHAIN = 3
GAP = 8
#: Rows that one range bucket of ids holds at most, about (Spark sorts it and may spill);
#: buckets per core while they are smaller, and rows that make a bucket worth its task.
BUCKET_ROWS, TASKS_PER_CORE, LEAST_ROWS = 200_000, 12, 500

# Common words of English, French, German and Spanish.
ANCHORS = frozenset(
    "a an and are as at be but by for from had has have he her his in is it not of on or said she that the there"
    " they this to was were what which will with would you"
    " au aux avec ce dans des du elle en est et il je la le les leur mais ne nous on ou par pas plus pour que qui"
    " sa se ses son sur un une vous"
    " als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für ich im ist mit nach"
    " nicht noch oder sich sie sind so um und uns unter vom von vor war wie zu zum zur über"
    " al como con del el era ese esta este ha hay las lo los me más muy no nos para pero por sin sobre su sus también"
    " todo una uno y ya".split()
)


def signatures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets per text into its sorted distinct signature hashes (32 bits)."""
    offsets, codes, tokens = W.word_codes(texts)
    plain = [W.bare(t) for t in tokens.to_pandas().tolist()]
    named = np.fromiter((len(p) > 0 for p in plain), bool, len(plain))
    keep = named[codes] if len(codes) else np.empty(0, bool)
    owner, code = W.owners(offsets)[keep], codes[keep]
    common = np.fromiter((p in ANCHORS for p in plain), bool, len(plain))[code]
    short = np.fromiter((len(p) < 2 for p in plain), bool, len(plain))[code]
    hashed = W.hashes(plain)[code]
    n = len(code)
    place = np.arange(n)
    first = np.searchsorted(owner, owner)  # where the text of each word begins
    # The last anchor before each word, or far away.
    last = np.maximum.accumulate(np.where(common, place, -1)) if n else place
    last = np.concatenate([[-1], last[:-1]]) if n else last
    lonely = ~common & ((last < first) | (place - last > GAP))
    anchored = np.flatnonzero(common | lonely)
    content = np.flatnonzero(~common & ~short)
    # An anchor word starts its chain after itself, a lonely word with itself.
    start = np.searchsorted(content, anchored + common[anchored])
    value = np.where(common[anchored], hashed[anchored], np.uint64(1))
    links = np.zeros(len(anchored), np.int64)
    for step in range(CHAIN):
        at = start + step
        ok = at < len(content)
        at = content[np.minimum(at, max(len(content) - 1, 0))] if len(content) else np.zeros(len(anchored), int)
        ok &= (owner[at] == owner[anchored]) if len(content) else False
        value = np.where(ok, W.scramble(value * W.MIX + hashed[at]), value)
        links += ok
    # A chain without any content word is no signature, unless the text has nothing else.
    many = np.bincount(owner[anchored][links > 0], minlength=len(texts)) if n else np.zeros(len(texts), int)
    full = (links > 0) | (many[owner[anchored]] == 0)
    owner, value, _ = W.distinct_per_owner(owner[anchored][full], (value[full] >> np.uint64(32)).astype(np.uint32))
    return np.searchsorted(owner, np.arange(len(texts) + 1)), value


def lengths_apart(a: int, b: int, threshold: float) -> bool:
    """True if sets of these lengths can't have the similarity."""
    return min(a, b) < threshold * max(a, b)


def jaccard(a: np.ndarray, b: np.ndarray, threshold: float = 0.0) -> float:
    """Similarity of two sorted sets; 0 as soon as it can't reach ``threshold``.

    Pruned by length first, then block by block: what is left of both sets
    bounds the intersection from above.
    """
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    if lengths_apart(len(a), len(b), threshold):
        return 0.0
    if threshold <= 0:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return common / (len(a) + len(b) - common)
    needed = threshold / (1 + threshold) * (len(a) + len(b))
    common, done_b, step = 0, 0, 256
    for s in range(0, len(a), step):
        part = a[s : s + step]
        stop = bisect.bisect_right(b, part[-1], done_b)
        common += len(np.intersect1d(part, b[done_b:stop], assume_unique=True))
        done_b = stop
        if common + min(len(a) - s - len(part), len(b) - done_b) < needed - 1e-9:
            return 0.0
    return common / (len(a) + len(b) - common)


def _hex(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, fingerprint (hex) and the number of signatures of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.slices(batches):
            bounds, found = signatures(W.texts_of(piece))
            hexed = [_hex(found[s:e]) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(hexed, pa.string()), pa.array(np.diff(bounds))],
                names=["doc_id", "fingerprint", "n_signatures"],
            )

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string, n_signatures long"
    )


def length_part(size: int, threshold: float) -> int:
    """Partition of a set length: similar sets lie in one partition or in neighbouring ones."""
    return int(math.log(size) / -math.log(threshold) + 1e-9) if size else -1


def sets_with_prefixes(docs: DataFrame, threshold: float, text: str = "text") -> DataFrame:
    """doc_id, the signatures as bytes, their length partition, and the prefix that similar sets share a member of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.slices(batches):
            bounds, found = signatures(W.texts_of(piece))
            sets = [found[s:e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            prefix = [s[: len(s) - math.ceil(threshold * len(s) - 1e-9) + 1].astype(np.int64) if len(s) else s for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([length_part(len(s), threshold) for s in sets], pa.int32()),
                    pa.array(prefix, pa.list_(pa.int64())),
                ],
                names=["doc_id", "signatures", "part", "prefix"],
            )

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, signatures binary, part int, prefix array<long>"
    )


def search(queries: DataFrame, docs: DataFrame, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """query_id, doc_id and likeness of all documents at least ``threshold`` like a query.

    Sets meet by length partition and signature: a query looks into its own
    partition and the two beside it, and only for the signatures of its prefix.
    Candidates are compared by pruned Jaccard, so the result is exact. Empty
    fingerprints match nothing; rows that share an id are searched on their own.
    """
    asked = sets_with_prefixes(queries, threshold, text).withColumnRenamed("doc_id", "query_id")
    held = sets_with_prefixes(docs, threshold, text)
    probes = asked.select(
        "query_id", F.explode("prefix").alias("signature"), F.array(*[F.col("part") + d for d in (-1, 0, 1)]).alias("parts")
    ).select("query_id", "signature", F.explode("parts").alias("part"))
    index = held.select("doc_id", "part", F.explode("prefix").alias("signature"))
    candidates = probes.join(index, ["part", "signature"]).select("query_id", "doc_id").distinct()
    both = candidates.join(asked.select("query_id", F.col("signatures").alias("one")), "query_id").join(
        held.select("doc_id", F.col("signatures").alias("two")), "doc_id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            likeness = [
                jaccard(np.frombuffer(a.as_buffer(), np.uint32), np.frombuffer(b.as_buffer(), np.uint32), threshold)
                for a, b in zip(batch.column("one"), batch.column("two"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id"), batch.column("doc_id"), pa.array(likeness, pa.float64())],
                names=["query_id", "doc_id", "likeness"],
            )

    found = both.select("query_id", "doc_id", "one", "two").mapInArrow(run, "query_id long, doc_id long, likeness double")
    return found.where(F.col("likeness") >= threshold)


def in_id_order(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows in range buckets of ``doc_id``, sorted, each bucket with the first row of the next one.

    Columns: bucket, guest (the row belongs to the next bucket), doc_id, text.
    Bucket borders are quantiles of the ids, about one bucket per task and none
    of much more than ``bucket_rows`` rows, so that no task sees all rows and
    the driver holds a border and a head per task. The last bucket gets the
    very first row. Null ids come last.
    """
    ids = docs.select(F.col("doc_id").cast("double").alias("__place"))
    rows = docs.count()
    tasks = TASKS_PER_CORE * docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-rows // bucket_rows), min(tasks, rows // LEAST_ROWS))
    cuts = ids.na.drop().approxQuantile("__place", [i / parts for i in range(1, parts)], 1 / (4 * parts)) if parts > 1 else []
    placed = docs.withColumn("__place", F.col("doc_id").cast("double"))
    if cuts:
        splits = [-math.inf, *sorted(set(cuts)), math.inf]
        cutter = Bucketizer(splits=splits, inputCol="__place", outputCol="__cut", handleInvalid="keep")
        placed = cutter.transform(placed).withColumn("__bucket", F.col("__cut").cast("int"))
    else:
        placed = placed.withColumn("__bucket", F.lit(0))
    placed = placed.select("doc_id", "text", "__bucket")
    # One row per bucket: its first row, bounded by the number of buckets.
    heads = placed.groupBy("__bucket").agg(F.min("doc_id").alias("head")).orderBy("__bucket").collect()
    if not heads:
        return docs.select(F.lit(0).alias("bucket"), F.lit(False).alias("guest"), "doc_id", "text")
    before = [(h["head"], heads[i - 1]["__bucket"]) for i, h in enumerate(heads)]
    spark = docs.sparkSession
    guests = F.broadcast(spark.createDataFrame(before, "head long, to int"))
    # Of several rows with a head's id, the first by text is the guest.
    visiting = (
        placed.join(guests, F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("doc_id", "to")
        .agg(F.min("text").alias("text"), F.max(F.col("text").isNull()).alias("__null"))
        .select(
            F.col("to").alias("bucket"), F.lit(True).alias("guest"), "doc_id",
            F.when(~F.col("__null"), F.col("text")).alias("text"),
        )
    )
    own = placed.select(F.col("__bucket").alias("bucket"), F.lit(False).alias("guest"), "doc_id", "text")
    return (
        own.unionByName(visiting)
        .repartition(len(heads), "bucket")
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first())
    )


def edited_likeness(docs: DataFrame, text: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they are.

    The edited text has its last quarter replaced by the beginning of the next
    document's text. Every text is read once, in the order of ids; the next
    document's fingerprint is computed once and handed back.
    """
    ordered = in_id_order(docs.select("doc_id", F.col(text).alias("text")), bucket_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row seen, not yet written: (bucket, guest, doc_id, text)
        for piece in W.slices(batches, "text", 4 << 20):
            rows = list(
                zip(
                    piece.column("bucket").to_pylist(),
                    piece.column("guest").to_pylist(),
                    piece.column("doc_id").to_pylist(),
                    W.texts_of(piece).to_pylist(),
                    strict=True,
                )
            )
            if held is not None:
                rows.insert(0, held)
            held = rows[-1]
            yield _compare(rows)

    return ordered.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )


def _compare(rows: list[tuple]) -> pa.RecordBatch:
    """Results of all rows but the last, which only serves as the next one."""
    own = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
    texts = [r[3] for r in rows]
    edited = []
    for i in own:
        quarter = len(texts[i]) // 4
        edited.append(texts[i][: len(texts[i]) - quarter] + texts[i + 1][:quarter])
    bounds, found = signatures(pa.array(texts + edited, pa.string()))
    sets = [found[s:e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
    changed = sets[len(texts) :]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[i][2] for i in own], pa.int64()),
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([_hex(sets[i]) for i in own], pa.string()),
            pa.array([_hex(s) for s in changed], pa.string()),
            pa.array([jaccard(sets[i], s) for i, s in zip(own, changed, strict=True)], pa.float64()),
            pa.array([jaccard(sets[i], sets[i + 1]) for i in own], pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )
