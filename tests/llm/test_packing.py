import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablework.llm import bpe, packing, words
from tablework.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def sequences(rows):
    found = defaultdict(list)
    for r in rows:
        found[r.sequence_id].append((r.offset, r.length))
    return found


def padding(found, size):
    totals = [sum(n for _, n in parts) for parts in found.values()]
    return sum(0 if t & (t - 1) == 0 else size - t for t in totals), sum(totals)


def check_layout(rows, size):
    found = sequences(rows)
    assert sorted(found) == list(range(len(found)))
    for parts in found.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size


def test_query_against_library(spark):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_packing"](spark, SF).collect()
    check_layout(rows, packing.SIZE)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, parts in pieces.items():
        ids = np.array(library.encode(texts[doc_id], add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    pad, total = padding(sequences(rows), packing.SIZE)
    assert pad < 0.05 * total


def one_by_one(counts, size):
    """Plain packer: every single piece into the emptiest pack that takes it."""
    packs = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [i for i, p in enumerate(packs) if p + length <= size]
            if fits:
                best = min(fits, key=lambda i: packs[i])
                packs[best] += length
            else:
                packs.append(length)
    return len(packs)


@pytest.mark.parametrize("counts", [{}, {7: 1}, {3: 100}, {10: 1, 6: 4, 4: 9, 1: 30}, {9: 5, 5: 5, 4: 2, 2: 17}])
def test_histogram_packs_like_single_pieces(counts):
    size = 10
    placed = packing.pack_histogram(counts, size)
    by_length, filled = defaultdict(list), defaultdict(list)
    for length, rank, number, first, offset in placed:
        by_length[length] += range(rank, rank + number)
        for k in range(number):
            filled[first + k].append((offset, length))
    assert {k: sorted(v) for k, v in by_length.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert len(filled) == one_by_one(counts, size)
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "same"), (None, "same"), (3, "word " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as sequence_id", "1 as rank")
    found = packing.pack_documents(docs, 512).collect()
    check_layout(found, 512)
    assert sum(r.length for r in found) == 1 + 1 + 1 + 2 + 2 + 30_001
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_many_salts_number_every_rank(spark):
    pieces = spark.range(5000).selectExpr(
        "id as doc_id", "0L as start", "id % 3 + 1 as length", "id as ids_crc32", "length as doc_tokens"
    )
    for length, n in ((1, 1667), (2, 1667), (3, 1666)):
        ranks = sorted(r.rank for r in packing.ranked(pieces, 50).where(f"length = {length}").collect())
        assert ranks == list(range(n))


def test_a_worker_holds_little_text_and_gives_memory_back():
    batch = pa.RecordBatch.from_pydict({"text": ["".join(f" w{i}x{n}" for n in range(400)) for i in range(8_000)]})
    assert batch.nbytes > 16 << 20
    groups = list(words.gathered([batch], "text", bpe.INDEX_BYTES))
    assert max(g.column("text").nbytes for g in groups) < 3 << 20
    assert sum(g.num_rows for g in groups) == batch.num_rows
    code = """
import re
import pyarrow as pa
from tablework.llm import words
def mb():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read()).group(1)) / 1024
texts = ["".join(f" w{i}x{n}" for n in range(400)) for i in range(5_000)]
words.word_codes(pa.array(["a"]))
before = mb()
def batches():
    for _ in range(2):
        yield pa.RecordBatch.from_pydict({"text": texts})
for piece in words.slices(batches(), "text", 16 << 20):
    words.word_codes(words.texts_of(piece))
print(mb() - before)
"""
    kept = float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert kept < 60
