"""Reconcile a DataFrame with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tablework.functions.times import naive_utc


def align(df: DataFrame, schema: StructType, stamps: dict[str, Column] | None = None) -> DataFrame:
    """Cast, add missing columns as typed NULLs, reorder and stamp.

    Values that cannot be converted become NULL; the job does not fail on them.
    """
    stamps = stamps or {}
    present = {f.name: f.dataType for f in df.schema}
    columns = []
    for field in schema:
        if field.name in stamps:
            value = stamps[field.name].cast(field.dataType)
        elif field.name in present:
            value = _converted(F.col(field.name), present[field.name], field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def union_aligned(frames: list[DataFrame], schema: StructType) -> DataFrame:
    """Union of frames whose columns or types drifted apart."""
    result = align(frames[0], schema)
    for frame in frames[1:]:
        result = result.unionByName(align(frame, schema))
    return result


def _converted(value: Column, source: DataType, target: DataType) -> Column:
    if source == target:
        return value
    if isinstance(target, StringType):
        return value.cast(target)
    if isinstance(target, TimestampNTZType) and isinstance(source, StringType):
        return naive_utc(value)
    if isinstance(target, (TimestampType, TimestampNTZType)) and isinstance(
        source, (TimestampType, TimestampNTZType)
    ):
        return value.cast(target)
    if isinstance(source, (ArrayType, MapType, StructType)) or isinstance(
        target, (TimestampType, TimestampNTZType)
    ):
        return value.cast("string").try_cast(target)
    return value.try_cast(target)
