import hashlib

import numpy as np
import pyarrow as pa

from tablework.llm import spotsigs
from tablework.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_sets(text):
    """Signatures of a text as readable tuples, word by word."""
    words = [p for p in (w.lower().strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in text.split()) if p]
    content = [i for i, w in enumerate(words) if w not in spotsigs.ANCHORS and len(w) > 1]
    found, bare = set(), set()
    last = None
    for i, w in enumerate(words):
        common = w in spotsigs.ANCHORS
        if common or last is None or i - last > spotsigs.GAP:
            chain = [words[j] for j in content if j >= i + common][: spotsigs.CHAIN]
            (found if chain else bare).add((w if common else None, *chain))
        if common:
            last = i
    return found or bare


def test_likeness_of_plain_signatures(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = {r.doc_id: r for r in QUERIES["op1_spotsigs"](spark, SF).collect()}
    assert set(found) == set(rows)
    ids = sorted(rows)
    for doc_id, after in zip(ids, ids[1:] + ids[:1], strict=True):
        text, row = rows[doc_id], found[doc_id]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + rows[after][:quarter]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        sets = [plain_sets(t) for t in (text, edited, rows[after])]
        assert len(row.fingerprint) == 8 * len(sets[0]) and len(row.edited_fingerprint) == 8 * len(sets[1])
        for likeness, other in ((row.near_edited, sets[1]), (row.near_next, sets[2])):
            union = sets[0] | other
            assert abs(likeness - (len(sets[0] & other) / len(union) if union else 1.0)) < 1e-9


def test_order_over_buckets(spark):
    rows = [(i * 7 % 101, f"text number {i * 7 % 101} of the row and more") for i in range(101)] + [(None, None), (50, "a twin"), (50, "a twin")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as bucket", "2 as guest").repartition(6)
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    expected = []
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, after = text or "", after or ""
        quarter = len(text) // 4
        expected.append((i, hashlib.sha256((text[: len(text) - quarter] + after[:quarter]).encode()).hexdigest()))
    for size in (5, 40, 1000):
        found = [(r.doc_id, r.edited_sha256) for r in spotsigs.edited_likeness(docs, bucket_rows=size).collect()]
        assert sorted(found, key=str) == sorted(expected, key=str)


def test_few_rows(spark):
    kind = "doc_id long, text string"
    assert spotsigs.edited_likeness(spark.createDataFrame([], kind)).count() == 0
    (row,) = spotsigs.edited_likeness(spark.createDataFrame([(1, None)], kind)).collect()
    assert (row.n_chars, row.fingerprint, row.near_edited, row.near_next) == (0, "", 1.0, 1.0)
    long = "the quick word " * 40_000
    rows = spotsigs.fingerprints(spark.createDataFrame([(1, long), (1, long), (2, "")], kind)).collect()
    assert [r.n_signatures for r in sorted(rows, key=str)][:2].count(rows[0].n_signatures) and len({r.fingerprint for r in rows}) == 2


def test_pruned_likeness_is_exact_above_its_threshold():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 900, rng.integers(0, 900)).astype(np.uint32)) for _ in range(2))
        exact = spotsigs.jaccard(a, b)
        pruned = spotsigs.jaccard(a, b, 0.4)
        assert pruned == exact if exact >= 0.4 else pruned in (0.0, exact)


def test_texts_stand_alone():
    texts = ["the cat sat on it", "", "lonely words only here", "a of the", "x", "the"]
    bounds, found = spotsigs.signatures(pa.array(texts))
    for i, text in enumerate(texts):
        assert found[bounds[i] : bounds[i + 1]].tolist() == spotsigs.signatures(pa.array([text]))[1].tolist()


def test_search_finds_what_brute_force_finds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rng = np.random.default_rng(4)
    near = []
    for row in docs.where("doc_id % 9 = 0").collect():
        words = row.text.split(" ")
        for at in rng.integers(0, len(words), max(1, len(words) // 60)):
            words[at] = "changed"
        near.append((10_000 + row.doc_id, " ".join(words)))
    held = docs.unionByName(spark.createDataFrame(near + [(20_000, ""), (20_001, None)], docs.schema))
    queries = held.where("doc_id % 10 = 0")
    sets = {r.doc_id: plain_sets(r.text or "") for r in held.collect()}
    asked = [r.doc_id for r in queries.collect()]
    for threshold in (0.8, 0.5):
        expected = {
            (q, d) for q in asked for d in sets
            if sets[q] and len(sets[q] & sets[d]) >= threshold * len(sets[q] | sets[d])
        }
        found = spotsigs.search(queries, held, threshold).collect()
        assert {(r.query_id, r.doc_id) for r in found} == expected and len(found) == len(expected)
    assert spotsigs.search(queries.limit(0), held).count() == 0


def test_similar_lengths_are_neighbours():
    for size in range(1, 400):
        for other in range(size, int(size / 0.8) + 1):
            assert abs(spotsigs.length_part(size, 0.8) - spotsigs.length_part(other, 0.8)) <= 1
