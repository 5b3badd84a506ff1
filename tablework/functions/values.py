"""Decoding of array-valued fields, money and byte counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_texts(array: Column | str) -> Column:
    """Every element as text."""
    return F.transform(_col(array), lambda v: v.cast("string"))


def list_text(array: Column | str) -> Column:
    return F.concat(F.lit("["), F.array_join(as_texts(array), ", "), F.lit("]"))


def joined_text(array: Column | str) -> Column:
    """Text arrays: non-empty items joined by a comma; '' when nothing is left."""
    kept = F.filter(_col(array), lambda v: v.isNotNull() & (v != ""))
    return F.array_join(kept, ", ")


def number_text(array: Column | str) -> Column:
    """Numeric arrays: '' when empty, the number when single, else list text."""
    values = _col(array)
    return (
        F.when(F.size(values) == 0, F.lit(""))
        .when(F.size(values) == 1, F.get(values, F.lit(0)).cast("string"))
        .otherwise(list_text(values))
    )


def unwrapped(array: Column | str) -> Column:
    """The only element of a one-element array; NULL for empty and longer ones."""
    values = _col(array)
    return F.when(F.size(values) == 1, F.get(values, F.lit(0)))


def unwrapped_text(texts: Column | str) -> Column:
    """NULL when empty, the element when single, list text when several."""
    values = _col(texts)
    return F.when(F.size(values) == 1, F.get(values, F.lit(0)).cast("string")).when(
        F.size(values) > 1, list_text(values)
    )


def first_or(array: Column | str, default: Column) -> Column:
    """First element, or the default when there is none."""
    return F.coalesce(F.get(_col(array), F.lit(0)), default)


def attribute_or(attrs: Column | str, key: str, default: Column) -> Column:
    return F.coalesce(_col(attrs)[key], default)


def money_text(amount: Column | str) -> Column:
    """Two-decimal text of an amount that carries two decimals."""
    return F.coalesce(_col(amount), F.lit(0.0)).cast(MONEY).cast("string")


def megabytes(size: Column | str) -> Column:
    return _col(size) / 1024 / 1024
