"""Exact de-duplication with skew-safe combining, in DataFrame expressions only.

Texts are equal when they are identical after deleting ASCII white space. Three
steps, each grouping by digest *and* full content: every map task combines its
own copies (partial aggregation), groups are merged per salt, and the winners
of the salts are combined. A group with a third of all rows thus reaches the
last step as at most one row per salt.

The winner is then handed back to the rows of its group by sha256, a second
64-bit hash and length of the content: carrying the content through that join
too would shuffle all texts once more.

Of equal texts, the row with the most code points in its original text stays,
then the one with the smallest id; a null id comes last. A null text is an
empty text, and all empty texts are one group. Very long texts are compared
whole. Rows repeated with the id and the length of the winner can't be told
apart: ``mark_copies`` marks all of them as kept, ``deduplicate`` returns one.
Empty tables give empty results. Columns of the input are kept; a clash with a
result name is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.columns import reserve

WHITE_SPACE = " \t\n\x0b\x0c\r"
#: Salts a content is merged in before its winners meet.
SALTS = 16

_WIDE = "decimal(38,0)"
_IDS = "36893488147419103232"  # 2^65: above every id, and above the place of a null id
_NULL_ID = "18446744073709551616"  # 2^64
_LOWEST = "9223372036854775808"  # 2^63


def normalised(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), WHITE_SPACE, "")


def _standing(text: str, doc_id: str) -> Column:
    """A number that is smallest for the row that stays."""
    length = F.char_length(F.coalesce(F.col(text), F.lit("")))
    place = F.coalesce(F.col(doc_id).cast(_WIDE) + F.lit(_LOWEST).cast(_WIDE), F.lit(_NULL_ID).cast(_WIDE))
    longest_first = (F.lit(2147483647) - length).cast("decimal(10,0)")
    return (longest_first * F.lit(_IDS).cast("decimal(20,0)") + place).cast(_WIDE)


def _id_of(standing: Column) -> Column:
    place = standing % F.lit(_IDS).cast("decimal(20,0)")
    return F.when(
        place < F.lit(_NULL_ID).cast("decimal(20,0)"), (place.cast(_WIDE) - F.lit(_LOWEST).cast(_WIDE)).cast("long")
    )


def mark_copies(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", salts: int = SALTS
) -> DataFrame:
    """``df`` with keep_id, group_size, kept and text_sha256 on every row."""
    reserve(df, ["keep_id", "group_size", "kept", "text_sha256"])
    content = normalised(text)
    keyed = df.select(
        F.sha2(content, 256).alias("__digest"),
        content.alias("__content"),
        _standing(text, doc_id).alias("__standing"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("__salt"),
    )
    merged = keyed.groupBy("__digest", "__content", "__salt").agg(
        F.min("__standing").alias("__standing"), F.count(F.lit(1)).alias("__rows")
    )
    groups = merged.groupBy("__digest", "__content").agg(
        F.min("__standing").alias("__standing"), F.sum("__rows").alias("__rows")
    )
    # Rows that are alone need no partner: only groups of two or more are joined back.
    groups = groups.where(F.col("__rows") > 1).select(
        F.col("__digest").alias("__of"),
        F.xxhash64("__content").alias("__of_hash"),
        F.char_length("__content").alias("__of_length"),
        F.col("__standing").alias("__best"),
        "__rows",
    )
    rows = df.select(
        "*",
        F.sha2(content, 256).alias("text_sha256"),
        F.xxhash64(content).alias("__hash"),
        F.char_length(content).alias("__length"),
        _standing(text, doc_id).alias("__standing"),
    )
    joined = rows.join(
        groups,
        (F.col("text_sha256") == F.col("__of"))
        & (F.col("__hash") == F.col("__of_hash"))
        & (F.col("__length") == F.col("__of_length")),
        "left",
    )
    best = F.coalesce("__best", "__standing")
    return joined.select(
        *[F.col(c) for c in df.columns],
        _id_of(best).alias("keep_id"),
        F.coalesce("__rows", F.lit(1)).cast("long").alias("group_size"),
        (F.col("__standing") == best).alias("kept"),
        "text_sha256",
    )


def deduplicate(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", salts: int = SALTS
) -> DataFrame:
    """The rows that stay, one per content, with the columns of ``df``.

    Rows repeated with the id of the kept one are told apart by their number;
    only such rows are numbered, the others pass.
    """
    marked = mark_copies(df, text, doc_id, salts).where("kept")
    nth = F.row_number().over(Window.partitionBy("text_sha256", doc_id).orderBy(F.col(text)))
    alone = marked.where(F.col("group_size") == 1)
    several = marked.where(F.col("group_size") > 1).withColumn("__nth", nth).where("__nth = 1")
    return alone.select(*df.columns).unionByName(several.select(*df.columns))
