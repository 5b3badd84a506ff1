import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablework.llm import gru, language
from tablework.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_shares(weights, text):
    """One text, byte after byte, stretch after stretch."""

    def bounded(x):
        return x / (1 + np.abs(x))

    def gate(x):
        return (1 + bounded(x)) / 2

    data = text.encode()
    total, many = np.zeros(len(weights["bias"])), 0
    for at in range(0, len(data), gru.STRETCH):
        stretch = data[at : at + gru.STRETCH]
        logits = [weights["bias"].astype(float) for _ in stretch]
        for side in ("ahead", "back"):
            units = len(weights[f"{side}_candidate"])
            u = weights[f"{side}_state"].astype(float)
            h = np.zeros(units)
            order = range(len(stretch)) if side == "ahead" else reversed(range(len(stretch)))
            for t in order:
                x = weights[f"{side}_input"][stretch[t]].astype(float)
                keep = gate(x[:units] + h @ u[:, :units])
                reset = gate(x[units : 2 * units] + h @ u[:, units : 2 * units])
                new = bounded(x[2 * units :] + reset * (h @ u[:, 2 * units :] + weights[f"{side}_candidate"]))
                h = (1 - keep) * new + keep * h
                logits[t] = logits[t] + h @ weights[f"{side}_output"]
        for byte, row in zip(stretch, logits, strict=True):
            if byte >= 128 or chr(byte).isalpha():
                odds = np.exp(row - row.max())
                total, many = total + odds / odds.sum(), many + 1
    return total / max(many, 1)


def batch(rng, texts):
    data, offsets = language._bytes_of(pa.array(texts))
    owner, start, length = gru.stretches(data, offsets)
    return (*gru.gathered(data, start, length), owner)


def test_shares_equal_a_plain_reader():
    rng = np.random.default_rng(1)
    weights = gru.fresh(3, seed=5)
    weights["ahead_candidate"] += rng.normal(0, 0.3, gru.UNITS).astype(np.float32)
    texts = ["a", "", "12 - 3", "ein Wort", "été ñandú " * 20, "x" * 64, "y" * 65, "日本語", " ".join(f"w{i}" for i in range(700))]
    found = language.label_shares(weights, pa.array(texts))
    for text, row in zip(texts, found, strict=True):
        assert np.allclose(row, plain_shares(weights, text), atol=2e-5)


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    codes, valid, owner = batch(rng, ["some words here, ", "été 12", "z" * 70])
    labels = np.array([0, 1, 2])[owner]
    weights = {k: v.astype(float) for k, v in gru.fresh(3, seed=3, units=5).items()}
    _, gradient = gru.loss_and_gradient(weights, codes, valid, labels)
    for name, value in weights.items():
        places = [tuple(rng.integers(0, n) for n in value.shape) for _ in range(6)]
        if name.endswith("input"):
            places = [(int(codes[rng.integers(0, 5), 0]), p[1]) for p in places]
        for place in places:
            old = value[place]
            value[place] = old + 1e-5
            high = gru.loss_and_gradient(weights, codes, valid, labels)[0]
            value[place] = old - 1e-5
            low = gru.loss_and_gradient(weights, codes, valid, labels)[0]
            value[place] = old
            assert np.isclose((high - low) / 2e-5, gradient[name][place], rtol=1e-3, atol=1e-7), name


def test_training_lowers_the_loss():
    codes, valid, owner = batch(None, ["abc abd " * 40, "xyz xyw " * 40])
    weights = gru.fresh(2, seed=1)
    before = gru.loss_and_gradient(weights, codes, valid, owner)[0]
    after = gru.loss_and_gradient(gru.fit(weights, codes, valid, owner, 10, 0.02, 0, batch=4), codes, valid, owner)[0]
    assert after < before / 4


def test_query_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = QUERIES["op11_language"](spark, SF).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    judged = [r for r in found if r.held_out and r.lang and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in judged) / len(judged) > 0.95


ROWS = [
    (1, None, "en"),
    (2, "", "de"),
    (3, "123 ... \n", "en"),
    (4, "the cat and the dog " * 9, "en"),
    (4, "the cat and the dog " * 9, "en"),
    (5, "der Hund und die Katze " * 4_000, "de"),
    (6, "le chien", None),
    (None, "ohne Nummer", "de"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").selectExpr("*", "'x' AS label", "1 AS shard")
    model = language.train(docs)
    assert model[0] == ["de", "en"]
    found = language.identify(docs, model).collect()
    assert len(found) == len(ROWS)
    by_id = {r.doc_id: r for r in found}
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert by_id[4].lang_pred == "en" and by_id[5].lang_pred == "de" and by_id[6].lang_pred in ("de", "en")
    assert len({(r.lang_pred, r.score) for r in found if r.doc_id == 4}) == 1
    assert language.identify(docs.limit(0), model).count() == 0
    for unlabelled in (docs.limit(0), docs.where("lang IS NULL")):
        none = language.train(unlabelled)
        assert {(r.lang_pred, r.score) for r in language.identify(docs, none).collect()} == {("und", 0.0)}
    with pytest.raises(ValueError):
        language.identify(docs.withColumn("score", F.lit(1)), model)


def test_equal_texts_equal_results(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", "doc_id")
    model = language.train(texts.where("doc_id % 3 = 0"))
    twice = texts.drop("doc_id").crossJoin(spark.range(2)).repartition(5)
    found = language.identify(twice, model).groupBy("text").agg(F.countDistinct("lang_pred", "score").alias("n"))
    assert found.where("n > 1").count() == 0
