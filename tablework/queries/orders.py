"""Orders: documents, landing, merge, history."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.text import order_sentence
from tablework.functions.times import floor_millis, iso_timestamp
from tablework.operators.flatten import flatten_orders, orders_by_day, status_distribution
from tablework.operators.intervals import create_versions, merge_commit, valid_at
from tablework.operators.publish import stage
from tablework.operators.sketch import write_sketches
from tablework.operators.upsert import upsert, upsert_partitions
from tablework.operators.versions import append_batch, as_of, history, read_changes
from tablework.plans.orders import KEY, merged_orders, newest_first
from tablework.queries.fixtures import (
    CHANGES_SQL,
    EVENT_ORDERS_SQL,
    FLAT_SQL,
    LANDING_SQL,
    LATER,
    LATEST,
    NOW,
    ORDER_COLUMNS_SQL,
    changes,
    discounted_documents,
    event_orders,
    landing,
    later_changes,
    ntz,
    order_documents,
    repeated_changes,
    table,
    times_as_text,
)
from tablework.queries.registered import query
from tablework.runtime import scratch_path
from tablework.sinks.layout import laid_out
from tablework.sinks.tables import append, create_namespace, create_orders_table, with_day, write_landing
from tablework.sources.tables import read_days, read_documents, read_landing, row_counts

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@query(f"WITH {FLAT_SQL} SELECT {ORDER_COLUMNS_SQL} FROM flat")
def flattened_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents to flat orders, amounts recomputed where absent."""
    return times_as_text(flatten_orders(order_documents(spark, sf_dir), NOW, split_documents=True))


@query(
    f"""WITH {FLAT_SQL}
    SELECT strftime("OrderDate", '%Y-%m-%d') AS order_day, count(*) AS n_orders,
           sum("TotalAmount"::DECIMAL(18,2))::DOUBLE AS total_amount
    FROM flat GROUP BY 1"""
)
def landing_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_orders(order_documents(spark, sf_dir), NOW, split_documents=True)
    return orders_by_day(flat)


@query(
    """SELECT 'orders/' || o_orderkey AS "OrderId", coalesce(round(sum((l_extendedprice * (1 - l_discount))::DECIMAL(24,8)
             * l_quantity::DECIMAL(10,0)), 2), 0)::DOUBLE AS "TotalAmount", count(l_orderkey) AS "LineCount"
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"""
)
def orders_in_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents flattened in their row; discounted prices carry more than two decimals."""
    documents = discounted_documents(spark, sf_dir)
    return flatten_orders(documents, NOW).select("OrderId", "TotalAmount", "LineCount")


@query(
    """WITH parts AS (
      SELECT l_orderkey, max((l_extendedprice * (1 - l_discount))::DECIMAL(24,8) * l_quantity::DECIMAL(10,0)) AS total
      FROM lineitem GROUP BY l_orderkey, l_linenumber)
    SELECT 'orders/' || o_orderkey AS "OrderId", coalesce(round(sum(total), 2), 0)::DOUBLE AS "TotalAmount",
           count(l_orderkey) AS "LineCount"
    FROM orders LEFT JOIN parts ON l_orderkey = o_orderkey GROUP BY o_orderkey"""
)
def orders_parts_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as numbered parts, each delivered twice; of rows with one number the larger counts."""
    documents = discounted_documents(spark, sf_dir, whole=False)
    twice = documents.unionByName(documents)
    return flatten_orders(twice, NOW, split_documents=True).select("OrderId", "TotalAmount", "LineCount")


MERGED_SQL = f"""{LANDING_SQL}, {CHANGES_SQL},
merged AS (SELECT * FROM changes UNION ALL
           SELECT * FROM landing t WHERE NOT EXISTS
             (SELECT 1 FROM changes s WHERE s."OrderId" = t."OrderId"))"""


@query(f"WITH {MERGED_SQL} SELECT {ORDER_COLUMNS_SQL} FROM merged")
def orders_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = landing(spark, sf_dir)
    return times_as_text(upsert(orders, changes(orders), KEY))


@query(
    f"""WITH {LANDING_SQL}, {CHANGES_SQL},
    repeated AS (
      SELECT * FROM changes UNION ALL
      SELECT * REPLACE ('S' AS "Status", TIMESTAMP '2023-06-01 00:00:00' AS "SyncedAt") FROM changes),
    newest AS (SELECT * EXCLUDE rn FROM (
      SELECT *, row_number() OVER (PARTITION BY "OrderId" ORDER BY "SyncedAt" DESC) AS rn
      FROM repeated) WHERE rn = 1),
    merged AS (SELECT * FROM newest UNION ALL
               SELECT * FROM landing t WHERE NOT EXISTS
                 (SELECT 1 FROM newest s WHERE s."OrderId" = t."OrderId"))
    SELECT {ORDER_COLUMNS_SQL} FROM merged"""
)
def orders_upsert_dup_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with stale copies: the newest row of a key wins."""
    orders = landing(spark, sf_dir)
    return times_as_text(upsert(orders, repeated_changes(orders), KEY, newest_first()))


@query(f'WITH {MERGED_SQL} SELECT "Status", count(*) AS count FROM merged GROUP BY 1')
def orders_status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = landing(spark, sf_dir)
    return status_distribution(merged_orders(orders, repeated_changes(orders)))


MOVED_SQL = f"""{EVENT_ORDERS_SQL},
moved AS (
  SELECT * REPLACE (CASE WHEN "Status" = 'error' THEN "OrderDate" + INTERVAL 40 DAY ELSE "OrderDate" END
                      AS "OrderDate",
                    CASE WHEN "Status" IN ('error', 'view') THEN TIMESTAMP '2024-01-02 00:00:00'
                    ELSE "SyncedAt" END AS "SyncedAt")
  FROM flat)"""


@query(
    f"""WITH {MOVED_SQL}
    SELECT {ORDER_COLUMNS_SQL}, strftime("OrderDate", '%Y-%m-%d') AS order_day FROM moved"""
)
def orders_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge into a table partitioned by day; some orders move to another day.

    Key sketches tell which days may hold the orders of the source.
    """
    path = scratch_path(spark, "orders")
    orders = with_day(event_orders(spark, sf_dir))
    laid_out(orders, "order_day", KEY).write.partitionBy("order_day").parquet(path)
    source = event_orders(spark, sf_dir).where("Status IN ('error', 'view')")
    later = F.col("OrderDate") + F.expr("INTERVAL 40 DAYS")
    source = source.withColumns(
        {
            "OrderDate": F.when(F.col("Status") == "error", later).otherwise(F.col("OrderDate")),
            "SyncedAt": ntz(LATER),
        }
    )
    sketch = scratch_path(spark, "orders-keys")
    write_sketches(spark.read.schema(orders.schema).parquet(path), sketch, KEY, "order_day")
    upsert_partitions(spark, path, with_day(source), KEY, "order_day", newest_first(), sketch)
    return times_as_text(spark.read.schema(orders.schema).parquet(path))


@query(
    f"""WITH {EVENT_ORDERS_SQL}
    SELECT {ORDER_COLUMNS_SQL}, strftime("OrderDate", '%Y-%m-%d') AS order_day FROM flat"""
)
def orders_table_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The managed orders table: created, filled and read back by its location."""
    space, path = f"orders_{uuid.uuid4().hex[:8]}", scratch_path(spark, "orders")
    create_namespace(spark, space)
    create_orders_table(spark, f"{space}.orders", path)
    append(with_day(event_orders(spark, sf_dir)), f"{space}.orders")
    rows = spark.read.schema(spark.table(f"{space}.orders").schema).parquet(path)
    # The files stay at their location; the names are only needed for the write.
    spark.sql(f"DROP NAMESPACE {space} CASCADE")
    return times_as_text(rows)


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all orders, the changes, and the later changes."""
    path = scratch_path(spark, "changes")
    orders = landing(spark, sf_dir)
    append_batch(orders, path, 1, NOW)
    append_batch(changes(orders), path, 2, LATER)
    append_batch(later_changes(orders), path, 3, LATEST)
    return read_changes(spark, path, orders.schema)


@query(
    f"""WITH {LANDING_SQL}, {CHANGES_SQL}
    SELECT 1 AS commit_id, '2024-01-01 00:00:00' AS committed_at, 'append' AS operation,
           (SELECT count(*) FROM landing) AS row_count
    UNION ALL SELECT 2, '2024-01-02 00:00:00', 'overwrite', (SELECT count(*) FROM changes)
    UNION ALL SELECT 3, '2024-01-03 00:00:00', 'overwrite',
           (SELECT count(*) FROM landing WHERE "Status" = 'F')"""
)
def commit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return times_as_text(history(_changes(spark, sf_dir), KEY, last=5))


@query(
    f"""WITH {MERGED_SQL} SELECT {ORDER_COLUMNS_SQL} FROM merged"""
)
def orders_as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after the second commit, with a third one in place."""
    return times_as_text(as_of(_changes(spark, sf_dir), KEY, version=2))


@query(f"WITH {MERGED_SQL} SELECT {ORDER_COLUMNS_SQL} FROM merged")
def orders_as_of_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same read by validity intervals: a range filter over open and closed versions."""
    path = scratch_path(spark, "versions")
    # Three batches are taken from it, so it is joined once.
    orders = stage(spark, landing(spark, sf_dir))
    create_versions(spark, path, orders.schema, buckets=16)
    batches = [(orders, NOW), (changes(orders), LATER), (later_changes(orders), LATEST)]
    for number, (batch, time) in enumerate(batches, start=1):
        merge_commit(spark, path, batch, KEY, number, time)
    return times_as_text(valid_at(spark, path, orders.schema, version=2))


@query(
    f"""WITH {MERGED_SQL}
    SELECT {ORDER_COLUMNS_SQL} FROM (
      SELECT * REPLACE (CASE "Status" WHEN 'F' THEN 'Y' ELSE "Status" END AS "Status",
                        CASE "Status" WHEN 'F' THEN TIMESTAMP '2024-01-03 00:00:00'
                        ELSE "SyncedAt" END AS "SyncedAt")
      FROM merged)"""
)
def orders_as_of_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return times_as_text(as_of(_changes(spark, sf_dir), KEY, at="2024-01-09 00:00:00"))


@query(
    f"""WITH {MERGED_SQL}, late AS (SELECT "OrderId", 'late ' || "Status" AS "Note" FROM landing WHERE "Status" = 'F')
    SELECT {ORDER_COLUMNS_SQL}, "Note" FROM (
      SELECT m.* REPLACE (CASE WHEN l."Note" IS NULL THEN m."Status" ELSE 'Y' END AS "Status",
                          CASE WHEN l."Note" IS NULL THEN m."SyncedAt" ELSE TIMESTAMP '2024-01-03 00:00:00' END AS "SyncedAt"),
             l."Note"
      FROM merged m LEFT JOIN late l USING ("OrderId"))"""
)
def orders_as_of_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest table when the last batch brings a column that earlier ones lack."""
    path = scratch_path(spark, "changes")
    orders = landing(spark, sf_dir)
    append_batch(orders, path, 1, NOW)
    append_batch(changes(orders), path, 2, LATER)
    late = later_changes(orders).withColumn("Note", F.lit("late F"))
    append_batch(late, path, 3, LATEST)
    return times_as_text(as_of(read_changes(spark, path, late.schema), KEY))


@query(
    f"""WITH {EVENT_ORDERS_SQL}
    SELECT {ORDER_COLUMNS_SQL} FROM (
      SELECT * REPLACE (CASE WHEN "OrderDate" < TIMESTAMP '2024-01-08' THEN 'W' ELSE "Status" END AS "Status")
      FROM flat)"""
)
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files by day; the first week is written a second time."""
    path = scratch_path(spark, "landing")
    write_landing(event_orders(spark, sf_dir), path)
    again = read_days(spark, path, "2024-01-01", "2024-01-07").withColumn("Status", F.lit("W"))
    write_landing(stage(spark, again), path)
    return times_as_text(read_landing(spark, path))


@query(f"WITH {FLAT_SQL} SELECT {ORDER_COLUMNS_SQL} FROM flat")
def document_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through JSON files with an explicit schema."""
    path = scratch_path(spark, "documents")
    order_documents(spark, sf_dir).write.json(path)
    return times_as_text(flatten_orders(read_documents(spark, path), NOW, split_documents=True))


@query(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
)
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({t: table(spark, sf_dir, t) for t in TABLES})


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"""
)
def orders_by_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership in a literal list, total order, first rows."""
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .select("o_orderkey", "o_orderstatus", "o_totalprice")
        .limit(10)
    )


@query(
    """SELECT event_id, strftime(coalesce(date_trunc('milliseconds', t), TIMESTAMP '2024-06-01 00:00:00'),
             '%Y-%m-%d %H:%M:%S.%g') AS parsed
    FROM (SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN NULL
                 WHEN 'view' THEN date_trunc('day', ts)::TIMESTAMP
                 WHEN 'click' THEN ts - INTERVAL 2 HOUR ELSE ts END AS t FROM events)"""
)
def iso_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text with zone, offset, date only, unreadable or absent."""
    full = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(F.col("event_type") == "error", F.lit("not a time"))
        .when(F.col("event_type") == "signup", F.lit(None))
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(F.col("event_type") == "click", F.concat(full, F.lit("+02:00")))
        .otherwise(F.concat(full, F.lit("Z")))
    )
    parsed = floor_millis(iso_timestamp(text, ntz("2024-06-01 00:00:00")))
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSS").alias("parsed")
    )


@query(
    f"""WITH {LANDING_SQL}
    SELECT 'Order ' || "OrderId" || '. Customer: ' || "CustomerId" || '. Status: ' || "Status"
           || '. Amount: $' || "TotalAmount"::DECIMAL(18,2)::VARCHAR
           || '. Ship to: ' || coalesce(nullif("ShipCity", 'NATION_3'), 'unknown') || ', '
           || "ShipCountry" || '. Items: ' || "LineCount" || ' line items' AS sentence
    FROM landing"""
)
def order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = landing(spark, sf_dir).withColumn("ShipCity", F.nullif("ShipCity", F.lit("NATION_3")))
    return orders.select(order_sentence().alias("sentence"))
