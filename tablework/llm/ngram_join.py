"""Near-duplicate join on word shingles by Jaccard similarity, with adaptive multi-match prefixes.

1. Documents with the same word sequence form a class; only its smallest id goes on.
2. Min-hash keys propose a leader for every document: of the classes with a key
   the one with the most rows. Exact similarity decides. A leader and the
   documents linked to it directly form a star, others a star of their own. In
   later steps a star costs one row per token.
3. Tokens are ordered from rare to frequent (counts over all documents in a
   table of fixed size; only the order depends on them). If two sets are similar,
   their prefixes of length n - ceil(t n) + m share m tokens, for any m up to
   ceil(t n). Each document lengthens its prefix by its estimated candidate cost
   and then asks for as many shared prefix tokens (``wanted``).
4. Every star is first compared with the centre of its tokens: of the stars that
   share a token the one in which it comes earliest. Links contract stars to
   components, so a family of linked copies costs a comparison per member.
5. Stars of different components meet at tokens that can be the first one they
   share: what is left of both sets from there can still make up the needed
   overlap, and their parity sketches don't differ too much. Those that share as
   many prefix tokens as both ask for are compared leader with leader, exactly.
6. Jaccard distance is a metric, so the leaders' distance tells which stars can
   hold a linked pair at all; what remains and whose sketches allow it is compared
   leader with members, then members that share a prefix token, while the two
   stars aren't connected.
7. Links are contracted to components: the smallest id reachable.

A parity sketch has a bit per hash value of a token, flipped by every token with
it. Two sets differ in at least as many tokens as their sketches in bits, so a
sketch rules out pairs and never one that is linked, at any size of the table.

A comparison ships the set of one document to its partner, not both to a third
place. No candidate is dropped and no group is cut: hot tokens cost one row per
star, and every linked pair of different texts ends in one component.

Defined cases: null and empty texts have no shingles and are linked with
nothing; with fewer than ``k`` words the whole sequence is the only shingle.
Very long texts are one set, whole. Rows sharing an id are one document for the
links (their smallest class wins); each gets a result row. A null id is kept as
its own component (null). An empty table gives an empty result. Other columns of
the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm import words as W
from tablework.runtime import scratch_path

#: Counters of the token frequency table, 4 MB, whatever the input.
COUNTERS_LOG2 = 20
#: Rows of the frequency table, which travels in slices.
SLICE_ROWS = 16
#: Min-hash keys that propose leaders, and how many of them a document shares with its leader.
KEYS, KEYS_ALIKE = 3, 2
#: Numbers of 64 bits in a parity sketch, and the logarithm of how many.
SKETCH, SKETCH_LOG2 = 8, 3
#: Most shared prefix tokens asked for; one more for each doubling of the estimated cost from this on.
LEVELS, COST_UNIT = 8, 16
#: Partners of one set that meet it in one task, and sets that one row of requests names.
PARTNERS, ASKS = 2_000, 500
#: Bytes of text that a task works on at once; a shingle takes several arrays of eight bytes.
SLICE_BYTES = 2 << 20
#: Bytes of sets that a task hands on at once.
SENT_BYTES = 8 << 20
#: Centres that a star is compared with before all its candidates.
CENTRES = 1
#: Up to this many ids (16 MB as a hash relation) travel as a broadcast; beyond, they are shuffled.
BROADCAST_IDS = 500_000

_U = np.uint64


def _stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read back.

    A checkpoint would compute them twice and keep the constraints of the plan,
    which pile up over the rounds of ``components``.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ngrams")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# sets of one slice of texts


def _sorted_sets(bounds: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of ``values`` sorted and without repeats, and the new bounds."""
    # Many short sorts of plain numbers are far cheaper than one of (owner, value).
    for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[start:stop].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    return np.concatenate([[0], np.cumsum(new)])[bounds], values[new]


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets per text into its sorted distinct shingle hashes, and a 128-bit hash of its words."""
    offsets, codes, tokens = W.word_codes(texts)
    hashed = W.hashes(pc.ascii_lower(tokens).to_numpy(zero_copy_only=False))
    seq = hashed[codes] if len(codes) else np.empty(0, _U)
    owner = W.owners(offsets)
    place = np.arange(len(seq)) - offsets[owner]
    words = np.diff(offsets)

    def whole(seed: int) -> np.ndarray:
        mixed = W.scramble((seq ^ _U(seed)) + W.MIX * (place + 1).astype(_U))
        total = np.concatenate([np.zeros(1, _U), np.cumsum(W.scramble(mixed), dtype=_U)])
        return total[offsets[1:]] - total[offsets[:-1]]

    sequence = np.stack([whole(0x51ED270B), whole(0x2545F491)], 1)
    rolled = np.zeros(len(seq), _U)
    for step in range(k):
        rolled[: len(seq) - step] = rolled[: len(seq) - step] * W.MIX + seq[step:] if step < len(seq) else 0
    # A text of fewer than k words has one value, that of its whole sequence.
    count = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    value = W.scramble(rolled[W.spread(offsets[:-1], count)])
    short = np.flatnonzero((words > 0) & (words < k))
    value[bounds[short]] = W.scramble(sequence[short, 0] ^ W.MIX)
    return *_sorted_sets(bounds, value), sequence


def sketches(bounds: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """One row of ``SKETCH`` numbers per set: the parity of its tokens at every bit."""
    sizes = np.diff(bounds)
    found = np.zeros((len(sizes), SKETCH), _U)
    if len(tokens):
        owner = np.repeat(np.arange(len(sizes)), sizes)
        place = (tokens >> _U(64 - SKETCH_LOG2)).astype(np.int64)
        # The tokens of a set ascend, so those of one number lie together.
        at = np.flatnonzero(np.diff(owner * SKETCH + place, prepend=-1))
        flips = _U(1) << ((tokens >> _U(58 - SKETCH_LOG2)) & _U(63))
        found[owner[at], place[at]] = np.bitwise_xor.reduceat(flips, at)
    return found


def _differ(x: Column, y: Column) -> Column:
    """Tokens that two sets don't share, at least."""
    bits = [F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(SKETCH)]
    return reduce(Column.__add__, bits).cast("long")


def _may_link(differ: Column, sizes: Column, num: int, den: int) -> Column:
    """Whether sets of these sizes together can be linked if so many tokens are in one of them only."""
    return differ * (num + den) <= sizes * (den - num)


def least(n, num: int, den: int):
    """ceil(t n): the overlap that a set of n needs with any partner."""
    return -(-(n * num) // den)


# one pass over the texts per need


def _ids(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id"), F.col(text).alias("text"))


def facts(docs: DataFrame, k: int, text: str = "text") -> DataFrame:
    """doc_id, number of shingles, word-sequence hash, min-hash keys and sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.slices(batches, "text", SLICE_BYTES):
            bounds, tokens, sequence = shingles(W.texts_of(piece), k)
            sizes = np.diff(bounds)
            keys = np.zeros((len(sizes), KEYS), np.int64)
            some = np.flatnonzero(sizes)
            for j in range(KEYS):
                if len(some):
                    mixed = W.scramble(tokens ^ _U(0x9E3779B1 * (j + 1)))
                    keys[some, j] = np.minimum.reduceat(mixed, bounds[some]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(sizes),
                    pa.array(sequence[:, 0].view(np.int64)),
                    pa.array(sequence[:, 1].view(np.int64)),
                    pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), KEYS).cast(pa.list_(pa.int64())),
                    pa.FixedSizeListArray.from_arrays(pa.array(sketches(bounds, tokens).view(np.int64).ravel()), SKETCH).cast(
                        pa.list_(pa.int64())
                    ),
                ],
                names=["doc_id", "n", "one", "two", "keys", "sketch"],
            )

    return _ids(docs, text).mapInArrow(run, "doc_id long, n long, one long, two long, keys array<long>, sketch array<long>")


def frequencies(docs: DataFrame, k: int, text: str = "text") -> np.ndarray:
    """Hashed token counts over all documents: 2^COUNTERS_LOG2 numbers, summed slice by slice."""
    shift, width = _U(64 - COUNTERS_LOG2), (1 << COUNTERS_LOG2) // SLICE_ROWS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTERS_LOG2, np.uint32)
        for piece in W.slices(batches, "text", SLICE_BYTES):
            _, tokens, _ = shingles(W.texts_of(piece), k)
            total += np.bincount((tokens >> shift).astype(np.int64), minlength=len(total)).astype(np.uint32)
        parts = [total[i * width : (i + 1) * width].tobytes() for i in range(SLICE_ROWS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICE_ROWS), pa.int32()), pa.array(parts)], names=["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
                held = sums.setdefault(number, np.zeros(width, np.uint32))
                held += np.frombuffer(counts.as_buffer(), np.uint32)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()])], names=["slice", "counts"]
            )

    kind = "slice int, counts binary"
    counted = _ids(docs, text).select("text").mapInArrow(count, kind)
    rows = counted.repartition(SLICE_ROWS, "slice").mapInArrow(add, kind).collect()
    total = np.zeros(1 << COUNTERS_LOG2, np.uint32)
    for row in rows:
        total[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["counts"], np.uint32)
    return total


def _asked(pairs: DataFrame) -> DataFrame:
    """doc_id, the (leader, salt) places its set goes to, and in how many places it waits itself."""
    waits = pairs.groupBy(F.col("b").alias("of")).agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("places"))
    many = pairs.groupBy(F.col("a").alias("by")).agg(F.ceil(F.count(F.lit(1)) / ASKS).alias("chunks"))
    salted = pairs.join(waits, F.col("b") == F.col("of")).join(many, F.col("a") == F.col("by"))
    goes = (
        salted.select(
            F.col("a").alias("doc_id"),
            F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"),
            F.struct(F.col("b").alias("leader"), F.pmod(F.xxhash64("a"), F.col("places")).cast("int").alias("place")).alias("to"),
        )
        .groupBy("doc_id", "chunk")
        .agg(F.collect_list("to").alias("goes"), F.lit(0).alias("places"))
    )
    none = F.array().cast("array<struct<leader: bigint, place: int>>")
    stays = waits.select(F.col("of").alias("doc_id"), F.lit(0).cast("bigint").alias("chunk"), none.alias("goes"), "places")
    both = goes.unionByName(stays).groupBy("doc_id", "chunk")
    return both.agg(F.flatten(F.collect_list("goes")).alias("goes"), F.max("places").alias("places")).drop("chunk")


def compare(pairs: DataFrame, docs: DataFrame, k: int, text: str = "text") -> DataFrame:
    """Distinct ``pairs`` (a, b) of ids with the sizes of intersection and union.

    The set of a goes to where the set of b waits; b should be the id with more
    partners. A set with very many partners waits in several places.
    """
    asked = _stored(_asked(pairs))
    size = asked.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("goes")), F.lit(0)).alias("goes")).first()
    few = size["rows"] + size["goes"] <= BROADCAST_IDS
    wanted = _ids(docs, text).join(F.broadcast(asked) if few else asked, "doc_id")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.slices(batches, "text", SLICE_BYTES):
            bounds, tokens, _ = shingles(W.texts_of(piece), k)
            raw, ids = memoryview(tokens.tobytes()), piece.column("doc_id").to_pylist()
            goes, places = piece.column("goes").to_pylist(), piece.column("places").to_pylist()
            rows, held = [], 0
            for i, (s, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                own = bytes(raw[8 * s : 8 * e])
                waits = [(ids[i], place, False) for place in range(places[i])]
                for leader, place, comes in [*waits, *((to["leader"], to["place"], True) for to in goes[i])]:
                    rows.append((leader, place, comes, ids[i], own))
                    held += len(own)
                    if held > SENT_BYTES:
                        yield _batch(rows, _SENT)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, _SENT)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting = None, []
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("leader", "place", "comes", "doc_id")]
            for leader, place, comes, doc_id, own in zip(*columns, batch.column("tokens"), strict=True):
                if (leader, place) != at:
                    at, waiting = (leader, place), []
                tokens = np.frombuffer(own.as_buffer(), _U)
                if not comes:
                    waiting.append(tokens)
                    continue
                for other in waiting:
                    common = len(np.intersect1d(tokens, other, assume_unique=True))
                    found.append((doc_id, leader, common, len(tokens) + len(other) - common))
            if found:
                yield _batch(found, _MET)

    sent = wanted.mapInArrow(send, "leader long, place int, comes boolean, doc_id long, tokens binary")
    # The waiting set comes first.
    placed = sent.repartition("leader", "place").sortWithinPartitions("leader", "place", "comes")
    return placed.mapInArrow(meet, "a long, b long, shared long, union long")


_SENT = pa.schema([("leader", pa.int64()), ("place", pa.int32()), ("comes", pa.bool_()), ("doc_id", pa.int64()), ("tokens", pa.binary())])
_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int64()), ("union", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


# stars


def stars_of(classes: DataFrame, docs: DataFrame, k: int, num: int, den: int, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Stars, and the links that made them (a, b).

    A star row has doc_id, n, sketch, star (the id of its leader), distance to the
    leader, whether the star has several members, how many, the smallest and
    greatest of their sizes (lo, hi) and the most tokens that one of them and the
    leader don't share (spread).
    """
    sets = classes.where("n > 0")
    keyed = sets.select("doc_id", "rows", F.posexplode("keys").alias("j", "key"))
    # The class with the most rows is the likeliest original; of equal ones the smallest id leads.
    first = F.struct((-F.col("rows")).alias("rows"), F.col("doc_id").alias("doc_id"))
    leaders = keyed.groupBy("j", "key").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("met")).where("met > 1")
    met = (
        keyed.join(leaders, ["j", "key"])
        .where(F.col("doc_id") != F.col("first.doc_id"))
        .groupBy(F.col("doc_id").alias("a"), F.col("first.doc_id").alias("b"), F.col("first.rows").alias("rank"))
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    # One leader each, with as many keys in common as similar sets mostly have; a document without one
    # is a star of its own, and its links are found later.
    nth = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("shared"), "rank", "b"))
    alike = met.where(F.col("shared") >= KEYS_ALIKE).withColumn("nth", nth).where("nth = 1")
    proposed = _stored(alike.select("a", "b", "rank"))
    linked = _linked(compare(proposed.select("a", "b"), docs, k, text), num, den)
    distance = (1 - F.col("shared") / F.col("union")).alias("distance")
    links = _stored(linked.select("a", "b", distance, (F.col("union") - F.col("shared")).alias("differ")).join(proposed, ["a", "b"]))
    # A leader leads only if it isn't linked to a leader of its own.
    led = links.select(F.col("a").alias("b")).distinct()
    direct = (
        links.join(led, "b", "left_anti")
        .groupBy(F.col("a").alias("doc_id"))
        .agg(F.min(F.struct("rank", "b", "distance", "differ")).alias("to"))
        .select("doc_id", F.col("to.b").alias("star"), "to.distance", "to.differ")
    )
    heads = sets.select(F.col("doc_id").alias("star"), F.col("n").alias("head_n"))
    members = (
        direct.join(sets.select("doc_id", "n"), "doc_id")
        .groupBy("star")
        .agg(F.min("n").alias("lo"), F.max("n").alias("hi"), (F.count(F.lit(1)) + 1).alias("members"), F.max("differ").alias("spread"))
    )
    several = members.join(heads, "star").select(
        "star", F.least("lo", "head_n").alias("lo"), F.greatest("hi", "head_n").alias("hi"), "members", "spread"
    )
    placed = sets.select("doc_id", "n", "sketch").join(direct, "doc_id", "left").select(
        "doc_id", "n", "sketch", F.coalesce("star", "doc_id").alias("star"), F.coalesce("distance", F.lit(0.0)).alias("distance")
    )
    placed = placed.join(several, "star", "left").withColumns(
        {
            "members": F.coalesce("members", F.lit(1)),
            "lo": F.coalesce("lo", "n"),
            "hi": F.coalesce("hi", "n"),
            "spread": F.coalesce("spread", F.lit(0)),
        }
    )
    return _stored(placed.withColumn("several", F.col("members") > 1)), links.select("a", "b")


def _linked(compared: DataFrame, num: int, den: int) -> DataFrame:
    return compared.where(F.col("shared") * den >= F.col("union") * num)


# candidates


def prefixes(docs: DataFrame, counts: np.ndarray, k: int, num: int, den: int, text: str = "text") -> DataFrame:
    """doc_id, n, prefix tokens from rare to frequent, the length of the plain prefix, and wanted matches."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    usual = max(1, int(counts.mean()))
    shift = _U(64 - COUNTERS_LOG2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for piece in W.slices(batches, "text", SLICE_BYTES):
            bounds, tokens, _ = shingles(W.texts_of(piece), k)
            sizes = np.diff(bounds)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            often = table[(tokens >> shift).astype(np.int64)]
            # Counters hold chance neighbours too: counts up to the usual one are alike.
            rank = np.log2(np.maximum(often / usual, 1) + 0.5).astype(np.uint8)
            # The tokens of a set ascend already, and small numbers are sorted by counting.
            order = np.concatenate(
                [np.empty(0, np.int64)]
                + [s + rank[s:e].argsort(kind="stable") for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            )
            tokens, often = tokens[order], often[order].astype(np.int64)
            plain = sizes - least(sizes, num, den) + 1
            place = np.arange(len(tokens)) - bounds[owner]
            # Counts bound the documents that a prefix token meets from above.
            cost = np.bincount(owner, np.where(place < plain[owner], often, 0), len(sizes))
            wanted = 1 + np.log2(1 + cost / COST_UNIT).astype(np.int64)
            wanted = np.minimum(np.minimum(wanted, LEVELS), np.maximum(least(sizes, num, den), 1))
            keep = place < (plain + LEVELS - 1)[owner]
            cut = np.concatenate([[0], np.cumsum(keep)])[bounds].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(tokens[keep].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(sizes), lists, pa.array(plain), pa.array(wanted)],
                names=["doc_id", "n", "tokens", "plain", "wanted"],
            )

    return _ids(docs, text).mapInArrow(run, "doc_id long, n long, tokens array<long>, plain long, wanted long")


def token_rows(prefixed: DataFrame) -> DataFrame:
    """One row per star and token of its members' prefixes, combined within each task.

    ``level`` is the first number of matches whose prefix holds the token, and
    ``left`` how much of a member's set comes from the token on, at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            tokens = lists.values.to_numpy()[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            sizes = np.diff(offsets)
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(tokens)) - offsets[row]
            level = np.maximum(place - batch.column("plain").to_numpy()[row] + 2, 1)
            left = batch.column("n").to_numpy()[row] - place
            star = batch.column("star").to_numpy()[row]
            order = np.lexsort((tokens, star))
            star, tokens, level, left, row = star[order], tokens[order], level[order], left[order], row[order]
            first = np.ones(len(star), bool)
            first[1:] = (star[1:] != star[:-1]) | (tokens[1:] != tokens[:-1])
            at = np.flatnonzero(first)
            if not len(at):
                continue
            level, left = np.minimum.reduceat(level, at), np.maximum.reduceat(left, at)
            wanted, lo = (batch.column(c).to_numpy()[row[at]] for c in ("wanted", "lo"))
            columns = (tokens[at], star[at], *(v.astype(np.int32) for v in (level, left, wanted, lo)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in columns], names=["token", "star", "level", "left", "wanted", "lo"]
            )

    return prefixed.mapInArrow(run, "token long, star long, level int, left int, wanted int, lo int")


def shared_tokens(
    docs: DataFrame, stars: DataFrame, counts: np.ndarray, k: int, num: int, den: int, text: str = "text"
) -> DataFrame:
    """The prefix tokens that several stars have: one row per star and token, with the centre of the token.

    The centre is the star in which the token comes earliest, so the one with
    the fewest rarer tokens; of equal ones the smallest id.
    """
    prefixed = prefixes(docs, counts, k, num, den, text).drop("n")
    placed = prefixed.join(stars.select("doc_id", "n", "star", "members", "lo"), "doc_id")
    # The members of a star need one number: its size estimates the cost, its smallest member the most allowed.
    allowed = F.greatest(F.ceil(F.col("lo") * num / den), F.lit(1))
    several = F.least(allowed, F.lit(LEVELS), 1 + F.floor(F.log2(F.col("members").cast("double"))))
    wanted = F.when(F.col("members") > 1, several).otherwise(F.col("wanted")).cast("long")
    rows = token_rows(placed.select("star", "n", "tokens", "plain", wanted.alias("wanted"), "lo"))
    # One shuffle by token serves the grouping, the count of stars and the centre.
    tokens = rows.repartition("token").groupBy("token", "star").agg(
        F.min("level").alias("level"), F.max("left").alias("left"), F.min("wanted").alias("wanted"), F.min("lo").alias("lo")
    )
    of_token = Window.partitionBy("token")
    earliest = F.struct((F.col("lo") - F.col("left")).alias("at"), *[F.col(c) for c in ("star", "level", "left", "wanted", "lo")])
    met = tokens.withColumns({"stars": F.count(F.lit(1)).over(of_token), "centre": F.min(earliest).over(of_token)}).where("stars > 1")
    return _stored(met.select("token", "star", "level", "left", "wanted", "lo", "centre"))


def _first_shared(x: str, y: str, num: int, den: int) -> Column:
    """Whether a token can be the first one that two similar stars share.

    It lies in the plain prefixes, and what is left of both sets from it on
    makes up the overlap: num / (num + den) of the sum of their sizes at least.
    """
    left = F.least(f"{x}.left", f"{y}.left").cast("long")
    sizes = (F.col(f"{x}.lo") + F.col(f"{y}.lo")).cast("long")
    return (F.greatest(f"{x}.level", f"{y}.level") == 1) & (left * (num + den) >= sizes * num)


def centre_pairs(met: DataFrame, num: int, den: int) -> DataFrame:
    """Each star with the centre of most of its tokens, if they are early enough in both.

    These comparisons come first and lose nothing: pairs that they leave out are
    candidates later.
    """
    rows = met.select(F.struct("star", "level", "left", "wanted", "lo").alias("x"), F.col("centre").alias("y"))
    shared = (
        rows.where((F.col("x.star") != F.col("y.star")) & _first_shared("x", "y", num, den))
        .groupBy(F.col("x.star").alias("a"), F.col("y.star").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    nth = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("n"), "b"))
    return shared.withColumn("nth", nth).where(F.col("nth") <= CENTRES).select("a", "b")


def shapes(stars: DataFrame) -> DataFrame:
    """What the leader of each star (star, n, sketch) and its members (hi, spread, members) look like."""
    return stars.where("doc_id = star").select("star", "n", "sketch", "hi", "spread", "members")


def candidate_stars(met: DataFrame, labels: DataFrame, shape: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of stars of different components that share enough prefix tokens early enough.

    Stars meet at a token that can be the first one they share, if their sketches
    allow a link; then the tokens that their lengthened prefixes share are counted. ``labels`` has doc_id and
    label of the stars that are linked to others.
    """
    named = met.join(labels.select(F.col("doc_id").alias("star"), "label"), "star", "left")
    early = (
        named.where("level = 1")
        .join(shape.select("star", "sketch", "hi", "spread"), "star")
        .select("token", "star", "level", "left", "lo", F.coalesce("label", "star").alias("label"), "sketch", "hi", "spread")
    )
    differ = _differ(F.col("x.sketch"), F.col("y.sketch")) - F.col("x.spread") - F.col("y.spread")
    found = (
        early.alias("x")
        .join(
            early.alias("y"),
            (F.col("x.token") == F.col("y.token"))
            & (F.col("x.star") < F.col("y.star"))
            & (F.col("x.label") != F.col("y.label"))
            & _first_shared("x", "y", num, den)
            & _may_link(differ, F.col("x.hi") + F.col("y.hi"), num, den),
        )
        .select(F.col("x.star").alias("a"), F.col("y.star").alias("b"))
        .distinct()
    )
    # As many rows as a prefix has tokens meet here.
    lists = met.groupBy("star").agg(F.collect_list(F.struct("token", "level")).alias("tokens"), F.min("wanted").alias("wanted"))
    one, two = (lists.select(*[F.col(c).alias(f"{c}_{side}") for c in lists.columns]) for side in ("a", "b"))
    both = found.join(one, F.col("a") == F.col("star_a")).join(two, F.col("b") == F.col("star_b"))
    wanted = F.least("wanted_a", "wanted_b")
    within = lambda c: F.transform(F.filter(c, lambda t: t["level"] <= wanted), lambda t: t["token"])
    shared = F.size(F.array_intersect(within("tokens_a"), within("tokens_b")))
    return both.where(shared >= wanted).select("a", "b")


# links and components


def components(links: DataFrame) -> DataFrame:
    """doc_id and the smallest id reachable, for all ids in ``links`` (a, b).

    Every round gives each id the smallest label around it and then the label of
    its label; rounds grow with the logarithm of the longest chain.
    """
    edges = _stored(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    )
    labels = _stored(edges.groupBy(F.col("a").alias("doc_id")).agg(F.least(F.min("b"), F.col("doc_id")).alias("label")))
    while True:
        around = (
            edges.join(labels.select(F.col("doc_id").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("doc_id"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(around, "doc_id").select("doc_id", "label", F.least("label", "near").alias("next"))
        # The label is an id itself: follow it, and hand the smaller label back to it.
        offers = step.where("next < label").groupBy(F.col("label").alias("doc_id")).agg(F.min("next").alias("offer"))
        step = step.join(offers, "doc_id", "left").select("doc_id", "label", F.least("next", "offer").alias("next"))
        jumped = step.alias("s").join(
            step.select(F.col("doc_id").alias("of"), F.col("next").alias("far")).alias("t"), F.col("s.next") == F.col("t.of"), "left"
        )
        moved = _stored(jumped.select("doc_id", F.col("label").alias("old"), F.least("next", "far").alias("label")))
        changed = moved.where("old <> label").limit(1).count()
        labels = moved.select("doc_id", "label")
        if not changed:
            return labels


def between_stars(links: DataFrame, stars: DataFrame) -> DataFrame:
    """Links of documents as links of their stars; those inside a star fall away."""
    at = stars.select("doc_id", "star")
    return (
        links.join(at.toDF("a", "sa"), "a")
        .join(at.toDF("b", "sb"), "b")
        .where("sa <> sb")
        .select(F.col("sa").alias("a"), F.col("sb").alias("b"))
        .distinct()
    )


def _labels(links: list[DataFrame], stars: DataFrame) -> DataFrame:
    """doc_id and label of the stars that links connect with others."""
    return components(between_stars(reduce(DataFrame.unionByName, links), stars))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b, …) of stars that aren't connected yet."""
    label = lambda c, name: labels.select(F.col("doc_id").alias(c), F.col("label").alias(name))
    named = pairs.join(label("a", "__la"), "a", "left").join(label("b", "__lb"), "b", "left")
    return named.where(F.coalesce("__la", "a") != F.coalesce("__lb", "b")).select(*pairs.columns)


def member_pairs(
    docs: DataFrame,
    apart: DataFrame,
    inside: DataFrame,
    shape: DataFrame,
    counts: np.ndarray,
    k: int,
    num: int,
    den: int,
    text: str = "text",
) -> DataFrame:
    """Pairs of members (a, b) of stars that may still be linked: near enough and with a shared prefix token.

    ``apart`` has the stars a and b with the gap of their leaders, ``inside`` the
    star, member, distance, n and sketch of all members.
    """
    far = 1 - num / den
    asked = apart.select(F.explode(F.array("a", "b")).alias("star")).distinct()
    members = inside.join(asked, "star", "left_semi")
    ids = members.select(F.col("member").alias("doc_id"))
    kept = _ids(docs, text).join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
    plain = prefixes(kept, counts, k, num, den)
    rows = (
        plain.select("doc_id", F.posexplode(F.slice("tokens", F.lit(1), F.col("plain").cast("int"))).alias("place", "token"))
        .join(members.withColumnRenamed("member", "doc_id"), "doc_id")
        .select("star", "token", "doc_id", "distance", "n", "sketch", (F.col("n") - F.col("place")).alias("left"))
    )
    rows = _stored(rows)
    one, two = rows.alias("x"), rows.alias("y")
    # The star with fewer members goes to the other one, so a large star doesn't go to all around it.
    members_of = lambda c: shape.select(F.col("star").alias(c), F.col("members").alias(f"members_{c}"))
    sized = apart.join(members_of("a"), "a").join(members_of("b"), "b")
    turned = F.col("members_a") > F.col("members_b")
    ways = sized.select(
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("small"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("large"), "gap"
    )
    ways = ways.join(
        shape.select(F.col("star").alias("large"), F.col("sketch").alias("led"), F.col("hi").alias("most"), "spread"), "large"
    )
    goes = ways.join(
        one,
        (F.col("small") == F.col("x.star"))
        & _may_link(_differ(F.col("led"), F.col("x.sketch")) - F.col("spread"), F.col("most") + F.col("x.n"), num, den),
    )
    met = goes.join(
        two,
        (F.col("large") == F.col("y.star"))
        & (F.col("x.token") == F.col("y.token"))
        & (F.col("gap") - F.col("x.distance") - F.col("y.distance") <= far + 1e-9)
        & (F.least("x.left", "y.left") * (num + den) >= (F.col("x.n") + F.col("y.n")) * num)
        & _may_link(_differ(F.col("x.sketch"), F.col("y.sketch")), F.col("x.n") + F.col("y.n"), num, den),
    )
    return met.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()


def star_links(docs: DataFrame, stars: DataFrame, k: int, num: int, den: int, text: str = "text") -> list[DataFrame]:
    """Links between stars: centres first, then leaders, then what the triangle inequality leaves open."""
    far = 1 - num / den
    counts, shape = frequencies(docs, k, text), shapes(stars)
    met = shared_tokens(docs, stars, counts, k, num, den, text)
    # Many stars share a centre, so it is the one that waits.
    central = _stored(compare(_stored(centre_pairs(met, num, den)), docs, k, text))
    links = [_linked(central, num, den).select("a", "b")]
    candidates = _stored(candidate_stars(met, _labels(links, stars), shape, num, den))
    done = central.select("a", "b").unionByName(central.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = _stored(candidates.join(done, ["a", "b"], "left_anti"))
    measured = _stored(compare(others, docs, k, text))
    links.append(_linked(measured, num, den).select("a", "b"))

    reach = stars.where("several").groupBy("star").agg(F.max("distance").alias("reach"))
    gap = 1 - F.col("shared") / F.col("union")
    open_pairs = (
        measured.unionByName(central.join(candidates.unionByName(candidates.select(F.col("b").alias("a"), F.col("a").alias("b"))), ["a", "b"], "left_semi"))
        .where(F.col("shared") * den < F.col("union") * num)
        .join(reach.select(F.col("star").alias("a"), F.col("reach").alias("ra")), "a", "left")
        .join(reach.select(F.col("star").alias("b"), F.col("reach").alias("rb")), "b", "left")
        .where(gap - F.coalesce("ra", F.lit(0.0)) - F.coalesce("rb", F.lit(0.0)) <= far + 1e-9)
        .where(F.col("ra").isNotNull() | F.col("rb").isNotNull())
        .select("a", "b", gap.alias("gap"))
    )
    open_pairs = _stored(open_pairs)
    if not open_pairs.limit(1).count():
        return links
    open_pairs = _stored(_apart(open_pairs, _labels(links, stars)))
    inside = stars.where("several AND doc_id <> star").select("star", F.col("doc_id").alias("member"), "distance", "n", "sketch")

    # Leader of one star with the members of the other; the leader waits.
    def beside(leader: str, other: str) -> DataFrame:
        led = shape.select(F.col("star").alias(leader), F.col("sketch").alias("led"), F.col("n").alias("led_n"))
        return (
            open_pairs.join(led, leader)
            .join(
                inside,
                (F.col(other) == F.col("star"))
                & (F.col("gap") - F.col("distance") <= far + 1e-9)
                & _may_link(_differ(F.col("led"), F.col("sketch")), F.col("led_n") + F.col("n"), num, den),
            )
            .select(F.col("member").alias("a"), F.col(leader).alias("b"))
        )

    near = beside("a", "b").unionByName(beside("b", "a"))
    links.append(_stored(_linked(compare(_stored(near.distinct()), docs, k, text), num, den).select("a", "b")))

    # Members with members, where the stars aren't connected by now.
    apart = _stored(_apart(open_pairs, _labels(links, stars)))
    if apart.limit(1).count():
        last = _stored(member_pairs(docs, apart, inside, shape, counts, k, num, den, text))
        links.append(_stored(_linked(compare(last, docs, k, text), num, den).select("a", "b")))
    return links


def near_duplicates(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row: links have num/den similarity at least."""
    known = _stored(facts(docs, k, text))
    groups = (
        known.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("one", "two")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    )
    groups = _stored(groups)
    # Rows that share an id but not their words are tied together by that id.
    classes = groups.groupBy(F.col("rep").alias("doc_id")).agg(
        F.max_by("n", "one").alias("n"), F.max_by("keys", "one").alias("keys"), F.max_by("sketch", "one").alias("sketch"), F.sum("rows").alias("rows")
    )
    stars, proposed = stars_of(classes, docs, k, num, den, text)
    links = star_links(docs, stars, k, num, den, text)
    merged = _labels([*links, proposed], stars)
    named = stars.join(merged.select(F.col("doc_id").alias("star"), "label"), "star", "left").select(
        "doc_id", F.coalesce("label", "star").alias("group")
    )
    # Components of stars are named after a leader; the documents take the smallest id in them.
    smallest = named.groupBy("group").agg(F.min("doc_id").alias("label"))
    labels = named.join(smallest, "group").select("doc_id", "label").where("doc_id <> label")
    # Only words that several rows have, or that are linked, need a partner here.
    final = (
        groups.join(labels.withColumnRenamed("doc_id", "rep"), "rep", "left")
        .where("rows > 1 OR label IS NOT NULL")
        .select(F.col("one").alias("__one"), F.col("two").alias("__two"), F.coalesce("label", "rep").alias("__label"))
    )
    return known.join(
        final, (F.col("one") == F.col("__one")) & (F.col("two") == F.col("__two")) & (F.col("n") > 0), "left"
    ).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("__label", "doc_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of every component the row with the smallest id."""
    found = near_duplicates(docs, k, num, den, text)
    gone = found.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
