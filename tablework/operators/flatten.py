"""Nested order documents to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.times import day_key, floor_millis, iso_timestamp, run_time
from tablework.functions.values import MONEY

_HEADER = ["OrderId", "CustomerId", "OrderDate", "Given", "Status", "ShipCity", "ShipCountry"]


#: Prices carry up to eight decimals until the sum is rounded.
PRICE, TOTAL = "decimal(24,8)", "decimal(38,8)"


def line_total(lines: Column | str) -> Column:
    """Sum of price times quantity inside the row, exact; it is rounded once, at the end."""
    values = F.col(lines) if isinstance(lines, str) else lines
    return F.aggregate(
        F.coalesce(values, F.array().cast("array<struct<ProductName:string,Price:double,Quantity:int>>")),
        F.lit(0).cast(TOTAL),
        lambda total, line: (
            total
            + F.coalesce(line["Price"].cast(PRICE), F.lit(0).cast(PRICE))
            * F.coalesce(line["Quantity"], F.lit(0)).cast("decimal(10,0)")
        ).cast(TOTAL),
    )


def flatten_orders(
    docs: DataFrame, now: Column | str | None = None, split_documents: bool = False
) -> DataFrame:
    """The nine landing columns of each document.

    A document is one row and is flattened in that row, without a shuffle. With
    ``split_documents`` a large document may arrive as several rows that share
    the id and header and each hold some of the lines; their totals are then
    combined by a pre-aggregated sum. A ``Part`` column numbers such rows: a part
    that was delivered twice then counts once.
    """
    when = run_time(now)
    numbered = split_documents and "Part" in docs.columns
    parts = docs.select(
        F.col("id").alias("OrderId"),
        F.coalesce("CustomerId", F.lit("")).alias("CustomerId"),
        floor_millis(iso_timestamp("OrderDate", when)).alias("OrderDate"),
        F.col("TotalAmount").cast(MONEY).alias("Given"),
        F.coalesce("Status", F.lit("Unknown")).alias("Status"),
        F.coalesce(F.col("ShipTo.City"), F.lit("")).alias("ShipCity"),
        F.coalesce(F.col("ShipTo.Country"), F.lit("")).alias("ShipCountry"),
        line_total("Lines").alias("Total"),
        F.coalesce(F.size("Lines"), F.lit(0)).cast("long").alias("LineCount"),
        *([F.col("Part")] if numbered else []),
    )
    if numbered:
        parts = parts.groupBy(*_HEADER, "Part").agg(
            F.max("Total").alias("Total"), F.max("LineCount").alias("LineCount")
        )
    if split_documents:
        parts = parts.groupBy(*_HEADER).agg(
            F.sum("Total").alias("Total"), F.sum("LineCount").alias("LineCount")
        )
    parts = parts.withColumn("Total", F.round("Total", 2).cast("decimal(38,2)"))
    # An absent or zero amount is replaced by the sum of the lines.
    amount = F.coalesce(
        F.nullif(F.col("Given"), F.lit(0).cast(MONEY)).cast("decimal(38,2)"), F.col("Total")
    )
    return parts.select(
        "OrderId",
        "CustomerId",
        "OrderDate",
        amount.cast("double").alias("TotalAmount"),
        "Status",
        "ShipCity",
        "ShipCountry",
        "LineCount",
        floor_millis(when).alias("SyncedAt"),
    )


def orders_by_day(orders: DataFrame) -> DataFrame:
    """Landing partitions: orders and amount per day."""
    return orders.groupBy(day_key("OrderDate").alias("order_day")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("TotalAmount").cast(MONEY)).cast("double").alias("total_amount"),
    )


def status_distribution(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("Status")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "Status")
    )
