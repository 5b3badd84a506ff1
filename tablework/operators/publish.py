"""Staged publish: write aside, audit, and only then make visible."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.versions import append_batch
from tablework.runtime import scratch_path


def stage(spark: SparkSession, df: DataFrame, path: str | None = None) -> DataFrame:
    """Write to a staging path and return a DataFrame that reads it back."""
    path = path or scratch_path(spark, "staged")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def audit(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Failures per rule; a rule is a predicate that holds for a bad row. One pass."""
    counted = df.agg(
        *[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in rules.items()]
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failures")) for n in rules]
    )
    return counted.select(F.inline(pairs))


#: A rule over a whole batch: from the staged rows to the rows (or keys) that break it.
SetRule = Callable[[DataFrame], DataFrame]


def unique(*keys: str) -> SetRule:
    """Broken once for every row beyond the first of a key; NULL is a key like any other."""

    def rule(staged: DataFrame) -> DataFrame:
        counts = staged.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("__extra")).where("__extra > 0")
        return counts.select(F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__extra"))).alias("nth"))

    return rule


def known_in(parents: DataFrame, column: str, parent_column: str) -> SetRule:
    """Broken by rows whose value no parent has; NULL has no parent."""
    wanted = parents.select(F.col(parent_column).alias("__parent"))
    return lambda staged: staged.join(wanted, F.col(column) == F.col("__parent"), "left_anti")


def unlike(stored: DataFrame, *keys: str) -> SetRule:
    """Broken by rows whose key the target holds already."""
    held = stored.select(*[F.col(k).alias(f"__{k}") for k in keys])

    def rule(staged: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        return staged.join(held, same, "left_semi")

    return rule


def rows_within(last: int, share: float) -> SetRule:
    """Broken once when the batch is smaller or larger than the ``last`` one by more than ``share`` of it."""
    return lambda staged: staged.agg(F.count(F.lit(1)).alias("n")).where(F.abs(F.col("n") - last) > share * last)


def audit_sets(df: DataFrame, rules: dict[str, Column], sets: dict[str, SetRule]) -> DataFrame:
    """Failures per rule, of rows and of the batch as a whole, as one plan over the staged rows."""
    result = audit(df, rules) if rules else None
    for name, rule in sets.items():
        broken = rule(df).agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("rule"), "failures")
        result = broken if result is None else result.unionByName(broken)
    return result


class AuditFailed(ValueError):
    """Raised instead of publishing rows that break a rule."""


def publish(
    staged: DataFrame,
    rules: dict[str, Column],
    path: str,
    commit_id: int,
    committed_at: Column | str | None = None,
    sets: dict[str, SetRule] | None = None,
) -> None:
    """Append the staged rows as a batch when no rule fails."""
    failed = audit_sets(staged, rules, sets or {}).where("failures > 0").collect()
    if failed:
        raise AuditFailed(", ".join(f"{r['rule']}: {r['failures']}" for r in failed))
    append_batch(staged, path, commit_id, committed_at)
