"""The pipeline's stages against plain versions, on the smallest table."""

from collections import defaultdict

import pytest

import corpus_pipeline
from tablework.llm import exact_dedup, quality, toxicity
from tests.llm.test_ngram_join import plain
from tests.llm.test_packing import check_layout

SF = "/root/testdata/sf0.001"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage got and returned, through Parquet."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(root / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        found[name] = (docs, after)
        docs = after
    return found


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "quality", "exact_dedup", "ngram_join", "packing"]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns
            assert set(texts(after).items()) <= set(texts(before).items())


def test_classifiers_decide(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, after = stages["toxicity"]
    judged = toxicity.classify(before.select("doc_id", "text"), labels)
    assert set(texts(after)) == {r["doc_id"] for r in judged.where("predicted = 0").collect()}
    before, after = stages["quality"]
    judged = quality.classify(before.select("doc_id", "text"), labels)
    assert set(texts(after)) == {r["doc_id"] for r in judged.collect() if r["score"] >= corpus_pipeline.POOR_BELOW}
    good = {r["doc_id"] for r in labels.where("quality = 1 AND toxic = 0").collect()} & set(texts(stages["toxicity"][0]))
    assert len(good & set(texts(after))) > 0.9 * len(good)


def test_copies_go(stages):
    before, after = stages["exact_dedup"]
    groups = defaultdict(list)
    for doc_id, text in texts(before).items():
        groups["".join(c for c in text if c not in exact_dedup.WHITE_SPACE)].append((-len(text), doc_id))
    assert set(texts(after)) == {min(g)[1] for g in groups.values()}


def test_near_copies_go(stages):
    before, after = stages["ngram_join"]
    rows = [(i, " ".join(t.split())) for i, t in texts(before).items()]
    components = plain(rows, 5, 80, 100)
    assert set(texts(after)) == {i for i, (_, root) in components.items() if i == root}


def test_packing_holds_every_document(stages):
    before, after = stages["packing"]
    rows = after.collect()
    check_layout(rows, 4096)
    assert {r["doc_id"] for r in rows} == set(texts(before))


def test_run_and_odd_rows(spark, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long, id long, score string, star int, `a.b` int"
    more = (5, "x", 1, 2)
    odd = [(1, None, "en", None, None, *more), (1, None, "en", None, None, *more), (2, "", None, "s", 0, *more), (3, "plain words " * 30, "en", "s", 9, *more)]
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    for name, rows in (("odd", odd), ("empty", [])):
        root = str(tmp_path / name)
        spark.createDataFrame(rows, kind).write.parquet(f"{root}/documents.parquet")
        labels.write.parquet(f"{root}/labels.parquet")
        found = corpus_pipeline.run(spark, root).collect()
        check_layout(found, 4096)
        assert len({r["doc_id"] for r in found}) == (2 if rows else 0)
