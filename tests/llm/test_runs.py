import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tablework.llm import runs
from tablework.llm import words as W
from tablework.llm.queries import QUERIES
from tablework.llm.recompression import grammar

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=24, times=3):
    """All runs by comparing the words of every period; the smallest period of a stretch counts."""
    words = np.array(words)
    n, found = len(words), {}
    for p in range(1, n // times + 1):
        same = np.concatenate([[False], words[p:] == words[:-p], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if e - s + p >= max(least, times * p):
                found.setdefault((s, e + p), p)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def find(texts, **sizes):
    offsets, codes, _ = W.word_codes(pa.array(texts, pa.string()))
    owner, *rest = runs.find(codes, offsets, **sizes)
    found = [[] for _ in texts]
    for i, run in zip(owner.tolist(), zip(*(r.tolist() for r in rest), strict=True), strict=True):
        found[i].append(run)
    return found


def odd_texts(rng, many):
    made = []
    for _ in range(many):
        n = int(rng.integers(1, 400))
        letters = rng.integers(0, rng.integers(1, 6), n)
        for _ in range(rng.integers(0, 3)):
            a, p = int(rng.integers(0, n)), int(rng.integers(1, 40))
            e = min(n, a + int(rng.integers(1, 8)) * p)
            letters[a:e] = letters[a + np.arange(e - a) % p]
        made.append(" ".join(f"w{c}" for c in letters))
    return made


def test_extensions_equal_a_plain_walk():
    rng = np.random.default_rng(3)
    for size, kinds in ((2, 2), (300, 1), (500, 2), (2_000, 3), (900, 40)):
        inner = rng.integers(0, kinds, size)
        inner[size // 2 :] = inner[: size - size // 2]
        symbols = np.concatenate([[kinds], inner, [kinds + 1]])
        for least in (4, 100):
            ahead = grammar(symbols, least)
            back = ahead.mirrored()
            i, j = rng.integers(1, size + 1, 300), rng.integers(1, size + 1, 300)
            i, j = i[i != j], j[i != j]
            last = len(symbols) - 1
            for x, y, f, b in zip(i, j, ahead.common(i, j), back.common(last - i, last - j), strict=True):
                k = 0
                while symbols[x + k] == symbols[y + k]:
                    k += 1
                assert f == k
                k = 0
                while symbols[x - k] == symbols[y - k]:
                    k += 1
                assert b == k


def test_grammar_shrinks():
    rng = np.random.default_rng(4)
    symbols = np.concatenate([[60_000], rng.integers(0, 50_000, 20_000), [60_001]])
    side = grammar(symbols, 16)
    assert len(side.symbols[-1]) <= 16 and sum(map(len, side.symbols)) < 12 * len(symbols)
    assert len(grammar(np.array([5] + [1] * 10_000 + [6]), 4).symbols) <= 4


@pytest.mark.parametrize(("least", "times"), [(24, 3), (8, 2), (12, 4)])
def test_runs_equal_brute_force(least, times):
    rng = np.random.default_rng(least)
    texts = [*odd_texts(rng, 150), "", " \t", "a", "a " * 23, "a " * 24, "a b c " * 30, "x y " * 12 + "z " + "x y " * 12]
    assert find(texts, least=least, times=times) == [plain_runs(t.split(), least, times) for t in texts]


def test_blocks_of_the_grid_change_nothing(monkeypatch):
    texts = odd_texts(np.random.default_rng(9), 40)
    whole = find(texts)
    monkeypatch.setattr(runs, "GRID_ROWS", 50)
    assert find(texts) == whole


def test_long_text_of_one_word():
    assert find(["go " * 30_000, "stop"]) == [[(0, 30_000, 1)], []]


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words) if n else []
    drop = set()
    for s, length, q in found:
        drop |= set(range(s + q, s + length))
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if found else None
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    rest = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(found), *best, milli, *(hashlib.sha256(t.encode()).hexdigest() for t in (listed, rest)))


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op12_runs"](spark, SF).collect()
    assert len(found) == len(docs) and any(r.n_runs for r in found)
    for row in found:
        assert tuple(row) == plain_digest(row.doc_id, docs[row.doc_id])


ODD = [(1, None), (2, ""), (3, " \n"), (4, "a b " * 40), (4, "a b " * 40), (5, "ä ö " * 5_000), (None, "q " * 30), (30, "one two three " * 20)]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'x' AS start", "1 AS n_runs")
    found = {(r.doc_id, r.text): r for r in runs.collapse(docs).collect()}
    assert len(found) == len(set(ODD)) and runs.collapse(docs).count() == len(ODD)
    assert [tuple(r) for r in found[4, "a b " * 40].runs] == [(0, 80, 2)] and found[4, "a b " * 40].collapsed == "a b"
    assert found[1, None].runs == [] and found[1, None].collapsed == "" and found[3, " \n"].collapsed == ""
    assert [tuple(r) for r in found[5, "ä ö " * 5_000].runs] == [(0, 10_000, 2)]
    assert runs.collapse(docs.limit(0)).count() == 0 and runs.digests(docs.limit(0)).count() == 0
    rows = runs.digests(docs).collect()
    known = [plain_digest(i, t) for i, t in ODD if i is not None]
    assert sorted(tuple(r) for r in rows if r.doc_id is not None) == sorted(known, key=lambda r: r) and len(rows) == len(ODD)
    with pytest.raises(ValueError):
        runs.collapse(docs.withColumnRenamed("start", "runs"))
    with pytest.raises(ValueError):
        runs.collapse(docs, least=4)
