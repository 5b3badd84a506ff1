"""The corpus pipeline: from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and, but for the last, returns the columns of ``docs``. ``run`` writes what a
stage returns as Parquet in the shared folder and reads it again for the next
one, so a lost executor costs at most the stage it was in.

Null texts count as empty, repeated rows are handled as the operators say, and
an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import exact_dedup, ngram_join, packing, quality, toxicity
from tablework.runtime import scratch_path

#: A document is rejected as poor below this score; the classifier's 0.7 marks good ones.
POOR_BELOW = 0.5
#: Near duplicates share this part of their five-word shingles.
SHINGLE_WORDS, SIMILARITY = 5, (80, 100)


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


#: Before names of columns that only pass through; no operator adds or reads such a name.
KEPT = "__kept_"


def _kept(docs: DataFrame) -> list[tuple[str, str]]:
    """Each column with the name that it passes through under: no operator adds it, and a dot in the column's own doesn't matter."""
    return [(c, c if c in ("doc_id", "text") else f"{KEPT}{i}") for i, c in enumerate(docs.columns)]


def _plain(docs: DataFrame) -> DataFrame:
    """The document columns under names that no operator adds."""
    return docs.select(*[F.col(f"`{c}`").alias(kept) for c, kept in _kept(docs)])


def _named(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(kept).alias(c) for c, kept in _kept(docs)])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = toxicity.classify(_plain(docs), _labels(spark, sf_dir))
    return _named(judged.where("predicted = 0"), docs)


def without_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.classify(_plain(docs), _labels(spark, sf_dir))
    return _named(judged.where(F.col("score") >= POOR_BELOW), docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _named(exact_dedup.deduplicate(_plain(docs)), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _named(ngram_join.keep_first(_plain(docs), SHINGLE_WORDS, *SIMILARITY), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_plain(docs))


STAGES = [
    ("toxicity", without_toxic),
    ("quality", without_poor),
    ("exact_dedup", without_copies),
    ("ngram_join", without_near_copies),
    ("packing", packed),
]

#: Trained models and tokens can't be had in SQL; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
