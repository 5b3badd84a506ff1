"""Documents, upserts, commits and staged publish on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablework.functions.text import order_sentence
from tablework.operators.flatten import flatten_orders
from tablework.operators.publish import AuditFailed, audit, publish, stage
from tablework.operators.upsert import newest_per_key, upsert, upsert_partitions
from tablework.operators.versions import append_batch, as_of, history, read_changes, stamped
from tablework.plans.inventory import registry_rules
from tablework.plans.orders import commit_landing, merge_landing, sync_documents, table_stats
from tablework.runtime import scratch_path
from tablework.schemas import FILE_REGISTRY, LANDING, ORDER_DOC, ORDERS
from tablework.sinks.tables import with_day, write_landing
from tablework.sources.tables import read_head, read_landing

NOW = "2024-05-01 12:00:00"


def doc(id, lines=None, total=None, date="2024-01-02T03:04:05", status="Shipped", ship=("Oslo", "Norway")):
    return (id, "c1", date, None, None, status, lines, total, ship, None)


def flatten(spark, rows, **options):
    df = spark.createDataFrame(rows, ORDER_DOC)
    return {r["OrderId"]: r for r in flatten_orders(df, NOW, **options).collect()}


def test_amount_is_recomputed_when_absent_or_zero(spark):
    lines = [("a", 0.1, 3), ("b", 2.25, 2)]
    found = flatten(
        spark,
        [
            doc("given", lines, 7.5),
            doc("absent", lines, None),
            doc("zero", lines, 0.0),
            doc("bare", None, None),
            doc("gaps", [("a", None, 3), ("b", 1.0, None)], None),
        ],
    )
    assert {k: r["TotalAmount"] for k, r in found.items()} == {
        "given": 7.5, "absent": 4.8, "zero": 4.8, "bare": 0.0, "gaps": 0.0,
    }
    assert found["bare"]["LineCount"] == 0 and found["given"]["LineCount"] == 2


def test_defaults_and_dates(spark):
    found = flatten(
        spark,
        [
            doc("z", date="2024-01-02T03:04:05.678912Z"),
            doc("offset", date="2024-01-02T03:04:05+02:00"),
            doc("bad", date="yesterday"),
            doc("year", date="2024"),
            doc("none", date=None),
            ("null", None, "2024-01-02", None, None, None, None, None, None, None),
        ],
    )
    now = dt.datetime(2024, 5, 1, 12)
    assert found["z"]["OrderDate"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert found["offset"]["OrderDate"] == dt.datetime(2024, 1, 2, 1, 4, 5)
    assert [found[k]["OrderDate"] for k in ("bad", "year", "none")] == [now] * 3
    blank = found["null"]
    assert (blank["CustomerId"], blank["Status"], blank["ShipCity"], blank["ShipCountry"]) == ("", "Unknown", "", "")
    assert blank["SyncedAt"] == now


def test_zoned_dates_do_not_depend_on_the_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = flatten(
            spark,
            [
                doc("z", date="2024-01-02T03:04:05Z"),
                doc("offset", date="2024-01-02T03:04:05+02:00"),
                doc("naive", date="2024-01-02T03:04:05"),
                doc("day", date="2024-01-02"),
            ],
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {k: r["OrderDate"] for k, r in found.items()} == {
        "z": dt.datetime(2024, 1, 2, 3, 4, 5),
        "offset": dt.datetime(2024, 1, 2, 1, 4, 5),
        "naive": dt.datetime(2024, 1, 2, 3, 4, 5),
        "day": dt.datetime(2024, 1, 2),
    }


def test_split_document_is_put_together(spark):
    rows = [doc("o", [("a", 1.5, 2)], None), doc("o", [("b", 2.0, 1)], None), doc("p", [("a", 1.0, 1)], 9.0)]
    found = flatten(spark, rows, split_documents=True)
    assert (found["o"]["TotalAmount"], found["o"]["LineCount"]) == (5.0, 2)
    assert (found["p"]["TotalAmount"], found["p"]["LineCount"]) == (9.0, 1)


def test_hot_order_is_split_and_counted_whole(spark, monkeypatch):
    from tablework.queries import fixtures

    monkeypatch.setattr(fixtures, "LINES_PER_DOCUMENT", 3)
    sf_dir = "/root/testdata/sf0.001"
    docs = fixtures.order_documents(spark, sf_dir)
    assert docs.count() > 1_500
    whole = fixtures.landing(spark, sf_dir).agg(F.sum("LineCount")).first()[0]
    split = flatten_orders(docs, NOW, split_documents=True)
    assert split.agg(F.sum("LineCount")).first()[0] == whole
    monkeypatch.setattr(fixtures, "LINES_PER_DOCUMENT", 1_000)
    plain = flatten_orders(fixtures.order_documents(spark, sf_dir), NOW, split_documents=True)
    assert split.exceptAll(plain).isEmpty() and plain.count() == split.count()


def orders(spark, rows):
    """(id, status, day of order, day of sync)"""
    full = [
        (i, "c", dt.datetime(2024, 1, day), 1.0, status, "", "", 1, dt.datetime(2024, 2, sync))
        for i, status, day, sync in rows
    ]
    return spark.createDataFrame(full, ORDERS)


def statuses(df):
    return {r["OrderId"]: r["Status"] for r in df.collect()}


def test_upsert_is_idempotent_and_counts_keys(spark):
    target = orders(spark, [("a", "old", 1, 1), ("b", "old", 1, 1)])
    source = orders(spark, [("b", "new", 1, 2), ("c", "new", 1, 2), ("c", "stale", 1, 1)])
    newest = [F.desc("SyncedAt")]
    once = upsert(target, source, ["OrderId"], newest)
    assert statuses(once) == {"a": "old", "b": "new", "c": "new"}
    assert once.count() == 3
    assert statuses(upsert(once, source, ["OrderId"], newest)) == statuses(once)


def test_upsert_rejects_null_keys(spark):
    source = orders(spark, [(None, "new", 1, 1)])
    with pytest.raises(Exception, match="NULL OrderId"):
        upsert(orders(spark, [("a", "old", 1, 1)]), source, ["OrderId"]).collect()


def test_partition_upsert_moves_rows_and_clears_emptied_days(spark):
    path = scratch_path(spark, "table")
    with_day(orders(spark, [("a", "old", 1, 1), ("b", "old", 2, 1), ("c", "old", 3, 1)])).write.partitionBy(
        "order_day"
    ).parquet(path)
    source = with_day(orders(spark, [("a", "new", 9, 2), ("d", "new", 2, 2)]))
    for _ in range(2):
        touched = upsert_partitions(spark, path, source, ["OrderId"], "order_day", [F.desc("SyncedAt")])
        found = spark.read.parquet(path)
        assert statuses(found) == {"a": "new", "b": "old", "c": "old", "d": "new"}
        assert found.count() == 4
    assert "2024-01-03" not in touched and "2024-01-09" in touched


@pytest.mark.parametrize("encoded", [False, True])
def test_partition_upsert_keeps_null_empty_and_escaped_partitions(spark, encoded):
    from tablework.operators.upsert import partition_key

    odd = ["x:1", "a/b", "c=d", "e f", "100%", "é"]
    rows = [("a", "x"), ("b", None), ("c", None), ("d", "")] + [(f"k{i}", v) for i, v in enumerate(odd)]

    def table(rows):
        df = spark.createDataFrame(rows, "id string, p string")
        return df.withColumn("key", partition_key("p")) if encoded else df

    name = "key" if encoded else "p"
    path = scratch_path(spark, "table")
    table(rows).write.partitionBy(name).parquet(path)
    changes = [("e", None)] + [(f"k{i}", "y" if i % 2 else "e f") for i in range(len(odd))]
    expected = {**dict(rows), **dict(changes)}
    if not encoded:
        expected["d"] = None
    for _ in range(2):
        upsert_partitions(spark, path, table(changes), ["id"], name)
        found = spark.read.schema(table(rows).schema).parquet(path)
        assert found.count() == len(expected)
        assert {r["id"]: r["p"] for r in found.collect()} == expected


def test_changes_as_of_versions_and_times(spark):
    path = scratch_path(spark, "changes")
    append_batch(orders(spark, [("a", "v1", 1, 1), ("b", "v1", 1, 1)]), path, 1, "2024-01-01 00:00:00")
    append_batch(orders(spark, [("c", "v2", 1, 1)]), path, 2, "2024-01-02 00:00:00")
    for _ in range(2):  # a repeated write replaces its own batch
        append_batch(orders(spark, [("a", "v3", 1, 1)]), path, 3, "2024-01-03 00:00:00")
    changes = read_changes(spark, path, ORDERS)
    assert [(r["commit_id"], r["operation"], r["row_count"]) for r in history(changes, ["OrderId"]).collect()] == [
        (3, "overwrite", 1), (2, "append", 1), (1, "append", 2),
    ]
    assert statuses(as_of(changes, ["OrderId"])) == {"a": "v3", "b": "v1", "c": "v2"}
    assert statuses(as_of(changes, ["OrderId"], version=1)) == {"a": "v1", "b": "v1"}
    assert statuses(as_of(changes, ["OrderId"], at="2024-01-02 12:00:00")) == {"a": "v1", "b": "v1", "c": "v2"}
    assert as_of(changes, ["OrderId"], at="2023-01-01 00:00:00").count() == 0
    assert as_of(changes, ["OrderId"]).columns == [f.name for f in ORDERS]


def test_as_of_keeps_a_column_that_came_later(spark):
    path = scratch_path(spark, "changes")
    append_batch(orders(spark, [("a", "1", 1, 1), ("b", "1", 1, 1)]), path, 1)
    late = orders(spark, [("b", "2", 1, 1)]).withColumn("Note", F.lit("n"))
    append_batch(late, path, 2)
    found = as_of(read_changes(spark, path, late.schema), ["OrderId"]).collect()
    assert {r["OrderId"]: r["Note"] for r in found} == {"a": None, "b": "n"}


def test_as_of_latest_equals_upsert(spark):
    first = orders(spark, [("a", "1", 1, 1), ("b", "1", 1, 1)])
    second = orders(spark, [("b", "2", 1, 1), ("c", "2", 1, 1)])
    changes = stamped(first, 1).unionByName(stamped(second, 2))
    assert statuses(as_of(changes, ["OrderId"])) == statuses(upsert(first, second, ["OrderId"]))


def registry(spark, rows):
    now = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(p, n, None, s, now) for p, n, s in rows], FILE_REGISTRY)


def test_publish_audits_before_commit(spark):
    path = scratch_path(spark, "registry")
    bad = stage(spark, registry(spark, [("/a", "a", 1), ("/b", "", 1), (None, "c", -1)]))
    counts = {r["rule"]: r["failures"] for r in audit(bad, registry_rules()).collect()}
    assert counts == {"missing_path": 1, "missing_name": 1, "negative_size": 1}
    with pytest.raises(AuditFailed, match="missing_name: 1"):
        publish(bad, registry_rules(), path, 1)
    good = stage(spark, registry(spark, [("/a", "a", 1)]))
    publish(good, registry_rules(), path, 2)
    assert [r["commit_id"] for r in read_changes(spark, path, FILE_REGISTRY).collect()] == [2]


def test_order_sentence(spark):
    rows = [("o1", "c", None, 2.5, None, "Oslo", None, 3, None), ("o2", "c", None, None, "New", "", "", None, None)]
    found = [r[0] for r in spark.createDataFrame(rows, LANDING).select(order_sentence()).collect()]
    assert found[0] == (
        "Order o1. Customer: c. Status: unknown. Amount: $2.50. Ship to: Oslo, unknown. Items: 3 line items"
    )
    assert "Amount: $0.00" in found[1] and "Items: 0 line items" in found[1]


def test_whole_flow_from_documents(spark):
    export, landing, table = (scratch_path(spark, n) for n in ("export", "landing", "table"))
    docs = [doc("a", [("x", 1.0, 2)]), doc("b", [("x", 1.0, 3)], date="2024-01-05")]
    spark.createDataFrame(docs, ORDER_DOC).write.json(export)
    assert read_landing(spark, landing) is None
    assert merge_landing(spark, landing, table) is None
    sync_documents(spark, export, landing, NOW)
    assert read_head(spark, landing, 1).count() == 1
    with_day(orders(spark, [("a", "old", 1, 1), ("z", "old", 1, 1)])).write.partitionBy("order_day").parquet(table)
    merge_landing(spark, landing, table)
    assert statuses(spark.read.parquet(table)) == {"a": "Shipped", "b": "Shipped", "z": "old"}

    path = scratch_path(spark, "changes")
    assert commit_landing(spark, landing, path, 1, NOW)
    changes = read_changes(spark, path, ORDERS)
    stats = table_stats(as_of(changes, ["OrderId"]), changes)
    assert stats["rows"].first()["cnt"] == 2
    assert stats["snapshots"].first()["operation"] == "append"


def test_landing_overwrites_one_day_only(spark):
    path = scratch_path(spark, "landing")
    write_landing(orders(spark, [("a", "1", 1, 1), ("b", "1", 2, 1)]), path)
    write_landing(orders(spark, [("c", "2", 2, 1)]), path)
    assert statuses(spark.read.parquet(path)) == {"a": "1", "c": "2"}


def test_large_day_is_cut_into_slots(spark):
    from tablework.sinks.layout import laid_out

    rows = with_day(orders(spark, [(f"o{i}", "1", 1 if i % 3 else 2, 1) for i in range(300)]))
    placed = laid_out(rows, "order_day", ["OrderId"], rows_per_file=20)
    assert placed.count() == 300 and placed.columns == rows.columns
    assert placed.rdd.getNumPartitions() >= 15
    spread = placed.where("order_day = '2024-01-01'").select(F.spark_partition_id()).distinct().count()
    assert spread >= 4


def test_newest_per_key_plan_cuts_groups_early(spark, plan):
    text = plan(newest_per_key(orders(spark, [("a", "1", 1, 1)]), ["OrderId"], [F.desc("SyncedAt")]), "simple")
    assert "WindowGroupLimit" in text
