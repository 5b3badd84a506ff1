import random

import numpy as np
import pyarrow as pa
import pytest

from tablework.llm import ngram_join
from tests.compare import connect
from tablework.llm.queries import ORACLES, QUERIES


def sets(text, k):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\x1d", "\x1d").split(" ") if w]
    if not words:
        return set()
    if len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def plain(rows, k, num, den):
    """Smallest id reachable, by comparing every pair."""
    found = {i: sets(t, k) for i, t in rows}
    ids = sorted(found)
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            shared = len(found[i] & found[j])
            if shared and den * shared >= num * (len(found[i]) + len(found[j]) - shared):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: (len(found[i]), root(i)) for i in ids}


def family(seed, base_words, copies, edits, first):
    """A text and copies of it with a few words changed; some far enough to stand alone."""
    rng = random.Random(seed)
    base = [f"w{seed}x{rng.randrange(4000)}" for _ in range(base_words)]
    rows = []
    for c in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        rows.append((first + c, " ".join(words)))
    return rows


def drifting(first, steps):
    """A chain: each text is like the one before, the ends aren't alike."""
    words = [f"d{i}" for i in range(120)]
    rows = []
    for s in range(steps):
        rows.append((first + s, " ".join(words)))
        at = (7 * s) % 120
        words[at] = f"d{s}changed"
    return rows


SMALL = [
    (0, "one"), (1, "ONE"), (2, "two words"), (3, "two  words "), (4, "words two"), (5, "a b c"), (6, "a b c d"), (7, "a b c d e"),
    (8, ""), (9, None), (10, " "), (11, "a b c d a b c d"), (12, "same " * 50), (13, "same " * 70),
]
SHARED = " ".join(f"license{i}" for i in range(60))


@pytest.mark.parametrize("k, num, den", [(4, 85, 100), (5, 80, 100)])
def test_against_all_pairs(spark, k, num, den):
    rows = SMALL + family(1, 100, 60, 5, 100) + family(2, 60, 40, 9, 200) + family(3, 400, 40, 20, 300) + drifting(400, 40)
    rows += [(500 + i, f"{SHARED} own{i} " + " ".join(f"o{i}x{j}" for j in range(i))) for i in range(40)]
    random.Random(0).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as star", "1 as n", "2 as keys").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, k, num, den).collect()}
    assert found == plain(rows, k, num, den)


def test_members_link_stars_whose_leaders_do_not(spark):
    """Leaders 0 and 1 are too far apart; only members of their stars are near each other."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for i in range(24):
        words = list(base)
        for at in rng.sample(range(0, 300, 5), rng.choice([0, 4, 8, 12])):
            words[at] = f"e{i}x{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()}
    assert found == plain(rows, 4, 85, 100)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    expected = sorted(connect(sf).sql(ORACLES["op7_ngram_join"]).df().itertuples(index=False, name=None))
    found = QUERIES["op7_ngram_join"](spark, sf).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(tuple(r) for r in found) == expected


def test_repeated_rows_null_ids_and_no_rows(spark):
    kind = "doc_id long, text string"
    assert ngram_join.near_duplicates(spark.createDataFrame([], kind)).count() == 0
    text = "a text of some words that repeats"
    rows = [(3, text), (3, text), (5, text), (None, text), (None, None), (7, "x " * 50_000), (8, "x " * 50_000 + "y")]
    found = sorted(map(tuple, ngram_join.near_duplicates(spark.createDataFrame(rows, kind)).collect()), key=str)
    assert found == sorted([(3, 4, 3), (3, 4, 3), (5, 4, 3), (None, 4, None), (None, 0, None), (7, 1, 7), (8, 2, 8)], key=str)
    kept = ngram_join.keep_first(spark.createDataFrame(rows, kind).selectExpr("*", "1 as component_id")).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [3, 3, 7, 8]


def test_prefixes_of_linked_sets_meet():
    """The bound behind the prefixes, on sets that are just similar enough."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(7, 200))
        shared = int(ngram_join.least(n, 85, 100))
        a = np.sort(rng.choice(10**6, n, replace=False))
        b = np.sort(np.concatenate([rng.choice(a, shared, replace=False), rng.integers(10**6, 2 * 10**6, (n - shared) // 9)]))
        if 100 * shared < 85 * (len(a) + len(b) - shared):
            continue
        for m in range(1, min(ngram_join.LEVELS, shared) + 1):
            cut = lambda s: s[: len(s) - ngram_join.least(len(s), 85, 100) + m]
            assert len(np.intersect1d(cut(a), cut(b))) >= m


def test_texts_stand_alone():
    texts = ["a b c d e", "", "x", "b c d e f", "x y"]
    bounds, tokens, sequence = ngram_join.shingles(pa.array(texts), 4)
    for i, text in enumerate(texts):
        one = ngram_join.shingles(pa.array([text]), 4)
        assert tokens[bounds[i] : bounds[i + 1]].tolist() == one[1].tolist() and sequence[i].tolist() == one[2][0].tolist()
    assert len(set(tokens[bounds[0] : bounds[1]]) & set(tokens[bounds[3] : bounds[4]])) == 1


def counted_pairs(monkeypatch):
    """How many pairs every comparison got."""
    seen, compare = [], ngram_join.compare

    def watched(pairs, *rest):
        seen.append(pairs.count())
        return compare(pairs, *rest)

    monkeypatch.setattr(ngram_join, "compare", watched)
    return seen


def edited(copies, changes, seed, words=200):
    rng = random.Random(seed)
    rows = []
    for c in range(copies):
        text = [f"b{i}" for i in range(words)]
        for at in rng.sample(range(words), changes):
            text[at] = f"e{c}x{at}"
        rows.append((c, " ".join(text)))
    return rows


@pytest.mark.parametrize("changes", [6, 1])
def test_pairs_grow_with_a_family_not_with_its_square(spark, monkeypatch, changes):
    """Copies that aren't linked make no pair, linked ones about one each."""
    seen, copies = counted_pairs(monkeypatch), 300
    docs = spark.createDataFrame(edited(copies, changes, copies), "doc_id long, text string")
    found = {r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert len(found) == (copies if changes == 6 else 1)
    assert sum(seen) <= 3 * copies


def test_a_large_star_does_not_meet_every_star_around_it(spark, monkeypatch):
    """Texts just too far from the leader of a star of many members; the members' distances alone would leave all pairs open."""
    monkeypatch.setattr(ngram_join, "frequencies", lambda *_: np.full(1 << ngram_join.COUNTERS_LOG2, 100, np.uint32))
    seen, members, around = counted_pairs(monkeypatch), 150, 40
    base = " ".join(f"b{i}" for i in range(200))
    texts = [base, base, base, *[t for _, t in edited(members, 2, 1)], *[t.replace("e", "f") for _, t in edited(around, 5, 2)]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()}
    assert found == plain(rows, 4, 85, 100)
    assert sum(seen) <= 3 * (members + around)


def test_pairs_do_not_depend_on_the_counts_of_tokens(spark, monkeypatch):
    """Full counters leave the order of the tokens to their hashes, as a large table does."""
    monkeypatch.setattr(ngram_join, "frequencies", lambda *_: np.full(1 << ngram_join.COUNTERS_LOG2, 100, np.uint32))
    seen, rows = counted_pairs(monkeypatch), edited(150, 9, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()}
    assert found == plain(rows, 4, 85, 100)
    assert sum(seen) <= 3 * len(rows)


def test_sketches_never_differ_in_more_bits_than_sets_in_tokens():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 3, 40, 40, 300, 300, 5000]
    common = rng.integers(0, 2**64 - 1, 5000, np.uint64)
    sets = [np.unique(np.concatenate([common[: n // 2], rng.integers(0, 2**64 - 1, n - n // 2, np.uint64)])) for n in sizes]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    found = ngram_join.sketches(bounds, np.concatenate(sets))
    for x, a in zip(sets, found, strict=True):
        for y, b in zip(sets, found, strict=True):
            bits, differ = int(np.bitwise_count(a ^ b).sum()), len(np.setxor1d(x, y))
            assert bits <= differ and (bits - differ) % 2 == 0
