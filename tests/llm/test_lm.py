import math
from collections import Counter

from tablework.llm import lm
from tablework.llm.queries import ORACLES, QUERIES
from tests.compare import connect

ROWS = [(1, "The cat sat. the cat ran"), (2, "the cat SAT."), (3, None), (4, ""), (4, "again a row"), (None, "no id"), (5, "x " * 30_000), (6, "the dog"), (6, "the dog")]


def plain(rows, vocabulary):
    texts = [(i, (t or "").translate({c: c + 32 for c in range(65, 91)}).split()) for i, t in rows]
    counts = Counter(w for _, words in texts for w in words)
    kept = {w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:vocabulary]}
    texts = [(i, [0] + [w if w in kept else 1 for w in words] + [0]) for i, words in texts]
    single = Counter(w for _, words in texts for w in words[:-1])
    pairs = Counter(p for _, words in texts for p in zip(words, words[1:], strict=False))
    total = sum(counts.values()) + len(texts)
    log = lambda x: math.floor(math.log(x) * 1e6 + 0.5)
    score = Counter()
    for i, words in texts:
        for h, w in zip(words, words[1:], strict=False):
            score[i] += log(pairs[h, w]) - log(single[h]) if pairs[h, w] >= 2 else log(single[w]) - log(total) + log(0.4)
    return {i: s / 1e6 for i, s in score.items()}


def test_against_plain_counts(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'x' as part", "2 as n").repartition(4)
    for vocabulary in (lm.VOCABULARY, 3):
        for part_rows in (lm.PART_ROWS, 500):
            found = {r.doc_id: r.log_score for r in lm.score(docs, vocabulary=vocabulary, part_rows=part_rows).collect()}
            assert found == plain(ROWS, vocabulary)


def test_no_rows(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_word_counts(spark):
    # More words than are broadcast.
    sf = "/root/testdata/sf0.01"
    expected = connect(sf).sql(ORACLES["op4_lm_score"]).fetchall()
    assert len(expected) == 1000
    found = QUERIES["op4_lm_score"](spark, sf).collect()
    assert sorted(tuple(r)[:4] for r in found) == sorted(r[:4] for r in expected)


def test_salt_until_codes_differ(spark):
    words = [f"w{i}" for i in range(6)]
    salt = lm.free_salt(spark.createDataFrame([(w,) for w in words], "word string"), bits=5)
    same = [len(set(lm.codes_of(words, s, 5).tolist())) < 6 for s in range(salt + 1)]
    assert same == [True] * salt + [False]
