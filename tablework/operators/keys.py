"""Unique serving keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.operators.numbering import WINDOW_GROUP_ROWS, number_within


def unique_keys(
    df: DataFrame, base: str, order: list[str], name: str, max_group: int = WINDOW_GROUP_ROWS
) -> DataFrame:
    """Add ``name``: ``base`` for the first row of a base, ``base_1``, ``base_2``… after it.

    A counter is skipped when some other row already carries that name as its
    own base ("run_1" beside a second "run"). ``order`` must be total within a
    base.
    """
    numbered = number_within(df, [base], order, "__n", max_group)
    plain = numbered.withColumn("__counter", F.col("__n"))

    # Bases of the form prefix_counter whose prefix really needs suffixes.
    repeated = numbered.where(F.col("__n") == 1).select(F.col(base).alias("__prefix"))
    pattern = r"^(.*)_([1-9][0-9]{0,17})$"
    taken = (
        numbered.where(F.col("__n") == 0)
        .select(
            F.regexp_extract(base, pattern, 1).alias("__prefix"),
            F.expr(f"try_cast(regexp_extract({base}, '{pattern}', 2) as bigint)").alias("__used"),
        )
        .where(F.col("__used").isNotNull())
        .join(repeated, "__prefix", "left_semi")
    )
    if not taken.isEmpty():
        plain = _skip_taken(numbered, taken, base, max_group)

    suffixed = F.concat(F.col(base), F.lit("_"), F.col("__counter").cast("string"))
    return plain.select(
        *df.columns, F.when(F.col("__n") == 0, F.col(base)).otherwise(suffixed).alias(name)
    )


def _skip_taken(numbered: DataFrame, taken: DataFrame, base: str, max_group: int) -> DataFrame:
    """Give the n-th repeat of a base the n-th counter that is still free.

    The i-th taken counter u (from 0) leaves u - 1 - i free ones below it, so
    it precedes the repeats from n = u - i on. Numbering both kinds together in
    that order makes the position plus one the free counter.
    """
    ranked = number_within(taken, ["__prefix"], ["__used"], "__i", max_group)
    markers = ranked.select(
        F.col("__prefix").alias(base),
        (F.col("__used") - F.col("__i")).alias("__at"),
        F.lit(0).alias("__kind"),
        F.col("__used").alias("__tie"),
    )
    touched = taken.select(F.col("__prefix").alias(base)).distinct()
    repeats = numbered.where(F.col("__n") > 0)
    places = markers.unionByName(
        repeats.join(touched, base, "left_semi").select(
            base, F.col("__n").alias("__at"), F.lit(1).alias("__kind"), F.col("__n").alias("__tie")
        )
    )
    shifted = (
        number_within(places, [base], ["__at", "__kind", "__tie"], "__place", max_group)
        .where(F.col("__kind") == 1)
        .select(base, F.col("__at").alias("__n"), (F.col("__place") + 1).alias("__free"))
    )
    return numbered.join(shifted, [base, "__n"], "left").withColumn(
        "__counter", F.coalesce("__free", "__n")
    )
