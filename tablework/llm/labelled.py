"""Bounded samples of labelled documents, for the operators that learn from labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels may be drawn with this resolution.
STEPS = 1 << 30


def fold(doc_id: str, parts: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(parts))


def draw(doc_id: str, salt: int) -> Column:
    """A number in 0..STEPS-1 for each id, for reproducible sampling."""
    return F.pmod(F.xxhash64(F.lit(salt), F.col(doc_id)), F.lit(STEPS))


def training_labels(labels: DataFrame, label: str, held_out: int, folds: int) -> DataFrame:
    """``doc_id`` and ``label`` (0 or 1) outside the held-out fold, one row per id.

    Rows with a null id or label are left out; of contradicting rows the larger
    label counts.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold("doc_id", folds) != held_out))
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col(label) > 0, 1).otherwise(0)).alias("label"))
    )


def sample(labels: DataFrame, rows: int, salt: int) -> DataFrame:
    """About ``rows`` rows of each label, drawn by id; all of them where there are fewer."""
    counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    keep = F.lit(False)
    for label, n in counts.items():
        share = min(STEPS, STEPS * rows // n)
        keep = keep | ((F.col("label") == label) & (draw("doc_id", salt) < share))
    return labels.where(keep)
