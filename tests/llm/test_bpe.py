import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablework.llm import bpe
from tablework.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [
    "", " ", None, "Hello world's déjà 123 <|endoftext|> x\x00y<|startoftext|>z <|ENDOFTEXT|>",
    "aaaa aaaaa aaaaaaa", "ΑΣ Σ İstanbul ﬁ é ́x", "a\x1cb\x85c d", "漢字 🙂🙂",
    "it'sdon't'll" * 3, "   lead trail  \n", "a<|endoftext|><|endoftext|>b", "a<|endoftext|><|endoftext|>b",
    "long " * 30_000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


def test_odd_texts(spark, library):
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "n int, text string, doc_id string")
    for row in bpe.encode(rows).collect():
        expected = library.encode(ODD[row.n] or "", add_special_tokens=False).ids
        assert row.ids == expected
        assert row.decoded == library.decode(expected, skip_special_tokens=False)
        assert row.doc_id == "x"


def test_decode_round_trip(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "n int, text string")
    both = bpe.decode(bpe.encode(rows).withColumnRenamed("decoded", "first"))
    assert both.where(F.col("first") != F.col("decoded")).count() == 0


def test_empty_and_clash(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(empty).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(spark.createDataFrame([], "ids string, text string"))


def test_query_against_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op6_bpe"](spark, SF).collect()
    assert {r.doc_id for r in found} == set(texts) and len(found) == len(texts)
    for row in found:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
