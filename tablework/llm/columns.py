"""Checks on column names that the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame


def reserve(df: DataFrame, names: list[str]) -> None:
    """Fail before any work when an input column has the name of a result."""
    clash = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are names of results; rename them first")
