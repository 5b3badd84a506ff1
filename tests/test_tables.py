import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.operators import intervals, publish, sketch
from tablework.operators.upsert import upsert, upsert_partitions
from tablework.operators.versions import append_batch, as_of, read_changes
from tablework.runtime import scratch_path
from tablework.schemas import FILE_METADATA
from tablework.sources.tables import read_drifting, vintages

ROW = "k string, v int, w string"


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- validity intervals


def batches(spark, seed=1, commits=6):
    rng = np.random.default_rng(seed)
    made = []
    for c in range(commits):
        keys = rng.choice(60, 25, replace=False)
        made.append(spark.createDataFrame([(f"k{k}", int(rng.integers(0, 9)), None if k % 7 == 0 else f"c{c}") for k in keys], ROW))
    return made


def test_intervals_equal_the_newest_rows_at_every_commit(spark, plan):
    path, changes = scratch_path(spark, "versions"), scratch_path(spark, "changes")
    made = batches(spark)
    schema = made[0].schema
    intervals.create_versions(spark, path, schema, buckets=5)
    for c, batch in enumerate(made, start=1):
        time = f"2024-01-0{c} 00:00:00"
        append_batch(batch, changes, c, time)
        intervals.merge_commit(spark, path, batch, ["k"], c, time)
        if c == 3:  # a run that is repeated changes nothing
            intervals.merge_commit(spark, path, batch, ["k"], c, time)
    stored = read_changes(spark, changes, schema)
    for c in range(len(made) + 2):
        at = f"2024-01-0{c} 12:00:00" if c else "2023-12-31 00:00:00"
        assert ordered(intervals.valid_at(spark, path, schema, version=c)) == ordered(as_of(stored, ["k"], version=c))
        assert ordered(intervals.valid_at(spark, path, schema, at=at)) == ordered(as_of(stored, ["k"], at=at))
        assert ordered(intervals.valid_at(spark, path, schema, 3, at)) == ordered(as_of(stored, ["k"], 3, at))
    assert ordered(intervals.valid_at(spark, path, schema)) == ordered(as_of(stored, ["k"]))
    text = plan(intervals.valid_at(spark, path, schema, version=4))
    assert "Window" not in text and "Exchange" not in text and "closed_in" in text.split("PartitionFilters")[-1]
    assert [r.commit_id for r in intervals.commits(spark, path).orderBy("commit_id").collect()] == list(range(1, 7))
    with pytest.raises(ValueError):
        intervals.merge_commit(spark, path, made[0], ["k"], 2)


def test_a_merge_that_stopped_between_its_writes_is_repeated(spark):
    path = scratch_path(spark, "versions")
    first, second = batches(spark, 2, 2)
    schema = first.schema
    intervals.create_versions(spark, path, schema, buckets=3)
    intervals.merge_commit(spark, path, first, ["k"], 1, "2024-01-01 00:00:00")
    before = intervals.open_versions(spark, path, schema).collect()
    intervals.merge_commit(spark, path, second, ["k"], 2, "2024-01-02 00:00:00")
    wanted = ordered(intervals.valid_at(spark, path, schema, 1)), ordered(intervals.valid_at(spark, path, schema, 2))
    # Closed versions are there, one bucket of the base isn't yet.
    old = spark.createDataFrame([r for r in before if r.bucket == 1], intervals.open_versions(spark, path, schema).schema)
    old.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{path}/current")
    intervals.merge_commit(spark, path, second, ["k"], 2, "2024-01-02 00:00:00")
    assert (ordered(intervals.valid_at(spark, path, schema, 1)), ordered(intervals.valid_at(spark, path, schema, 2))) == wanted


def test_interval_merges_refuse_null_keys_and_take_new_columns(spark):
    path = scratch_path(spark, "versions")
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], ROW)
    intervals.create_versions(spark, path, rows.schema, buckets=2)
    intervals.merge_commit(spark, path, rows, ["k"], 1, "2024-01-01 00:00:00", [F.desc("v")])
    wider = spark.createDataFrame([("a", 9, "q", True)], ROW + ", more boolean")
    intervals.merge_commit(spark, path, wider, ["k"], 2, "2024-01-02 00:00:00")
    assert ordered(intervals.valid_at(spark, path, wider.schema)) == [("a", 9, "q", True), ("b", 3, "z", None)]
    assert ordered(intervals.valid_at(spark, path, rows.schema, 1)) == [("a", 2, "y"), ("b", 3, "z")]
    assert intervals.merge_commit(spark, path, wider.limit(0), ["k"], 3, "2024-01-03 00:00:00") == []
    with pytest.raises(Exception, match="NULL k"):
        intervals.merge_commit(spark, path, spark.createDataFrame([(None, 1, "x")], ROW), ["k"], 4)


# --- key sketches


def test_filters_know_all_their_keys():
    rng = np.random.default_rng(4)
    held = rng.integers(-(2**63), 2**63 - 1, 5_000)
    bits = sketch.bloom(held)
    assert all(sketch.knows_any(bits, held[i : i + 1]) for i in range(0, 5_000, 50))
    others = rng.integers(-(2**63), 2**63 - 1, 3_000)
    assert sum(sketch.knows_any(bits, others[i : i + 1]) for i in range(3_000)) < 90
    assert not sketch.knows_any(bits, np.empty(0, np.int64))


def table_with_sketch(spark):
    path, keys = scratch_path(spark, "table"), scratch_path(spark, "keys")
    rows = spark.range(4_000).select(
        F.concat(F.lit("k"), "id").alias("k"),
        F.lit(0).alias("v"),
        F.when(F.col("id") % 40 != 39, F.concat(F.lit("p"), (F.col("id") % 40).cast("string"))).alias("part"),
    )
    rows.write.partitionBy("part").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    sketch.write_sketches(stored, keys, ["k"], "part")
    return path, keys, rows.schema, stored


def test_only_partitions_that_may_hold_a_key_are_searched(spark, monkeypatch):
    path, keys, schema, stored = table_with_sketch(spark)
    # k3 moves from p3, k79 from the partition without a value, new keys arrive.
    source = spark.createDataFrame([("k3", 1, "p7"), ("k79", 1, "p7"), ("n1", 1, "p1"), ("n2", 1, "new")], schema)
    found = {r.part for r in sketch.may_hold(spark, keys, source, ["k"], "part").collect()}
    assert {"p3", None} <= found and len(found) < 10
    wanted = ordered(upsert(stored, source, ["k"]))
    touched = upsert_partitions(spark, path, source, ["k"], "part", sketch=keys)
    assert touched == sorted(["p3", "p7", "p1", "new", "None"])
    assert ordered(spark.read.schema(schema).parquet(path).select("k", "v", "part")) == wanted
    # The sketches follow the rows: k3 is known in p7 now and no longer searched in p3.
    again = spark.createDataFrame([("k3", 2, "p9")], schema)
    found = {r.part for r in sketch.may_hold(spark, keys, again, ["k"], "part").collect()}
    assert "p7" in found and "p3" not in found
    assert upsert_partitions(spark, path, again, ["k"], "part", sketch=keys) == ["p7", "p9"]
    monkeypatch.setattr(sketch, "BROADCAST_KEYS", 0)
    assert sketch.may_hold(spark, keys, again, ["k"], "part") is None
    assert upsert_partitions(spark, path, spark.createDataFrame([("k3", 3, "p2")], schema), ["k"], "part", sketch=keys) == ["p2", "p9"]
    assert spark.read.schema(schema).parquet(path).where("k = 'k3'").collect()[0].part == "p2"


def test_sketches_of_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(sketch, "CHUNK_KEYS", 30)
    path, keys, schema, stored = table_with_sketch(spark)
    held = sketch.read_sketches(spark, keys, schema["part"])
    assert held.count() > 100 and held.agg(F.sum("n")).first()[0] == 4_000
    assert sketch.may_hold(spark, keys, stored, ["k"], "part").count() == 40


def test_upsert_reads_its_source_once(spark, plan):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], ROW)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def noted(v):
        seen.add(1)
        return v

    source = spark.createDataFrame([("b", 2, "z"), ("c", 2, "z")], ROW).withColumn("v", noted("v"))
    assert ordered(upsert(target, source, ["k"])) == [("a", 1, "x"), ("b", 2, "z"), ("c", 2, "z")]
    assert seen.value == 2


# --- vintages


def test_snapshots_meet_in_one_scan_per_vintage(spark, plan):
    root = scratch_path(spark, "snapshots")
    kinds = ["file_path string, file_size_bytes bigint", "file_path string, file_size_bytes string, title string", "file_path string, duration double, title int"]
    paths = []
    for i in range(24):
        kind = kinds[i % 3]
        row = (f"/f{i}", *((i, "t")[:1] if i % 3 == 0 else (str(i), "t") if i % 3 == 1 else (i / 2, i)))
        path = f"{root}/s{i}"
        spark.createDataFrame([row], kind).coalesce(1).write.parquet(path)
        paths.append(path)
    groups = vintages(spark, paths)
    assert [len(members) for _, members in groups] == [8, 16] or [len(m) for _, m in groups] == [16, 8] or len(groups) <= 3
    found = read_drifting(spark, paths, FILE_METADATA)
    assert plan(found, "simple").count("FileScan parquet") == len(groups) <= 3
    rows = {r.file_path: r for r in found.collect()}
    assert len(rows) == 24
    assert [rows["/f3"].file_size_bytes, rows["/f4"].file_size_bytes, rows["/f5"].duration] == [3, 4, 2.5]
    assert [rows["/f3"].title, rows["/f4"].title, rows["/f5"].title] == [None, "t", "5"]


# --- audits over sets


def test_set_rules(spark):
    staged = publish.stage(spark, spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), (None, -1, "p"), (None, 1, None), ("b", 1, "p")], ROW))
    parents = spark.createDataFrame([("p",), ("p",)], "name string")
    target = spark.createDataFrame([("b",), (None,)], "k string")
    sets = {
        "twice": publish.unique("k"),
        "parent": publish.known_in(parents, "w", "name"),
        "held": publish.unlike(target, "k"),
        "less": publish.rows_within(10, 0.4),
        "alike": publish.rows_within(6, 0.2),
    }
    found = {r.rule: r.failures for r in publish.audit_sets(staged, {"negative": F.col("v") < 0}, sets).collect()}
    assert found == {"negative": 1, "twice": 2, "parent": 2, "held": 3, "less": 1, "alike": 0}
    path = scratch_path(spark, "published")
    with pytest.raises(publish.AuditFailed, match="twice: 2"):
        publish.publish(staged, {}, path, 1, datetime.datetime(2024, 1, 1).isoformat(" "), sets={"twice": sets["twice"]})
    assert publish.stage(spark, staged).count() == 5
    publish.publish(staged, {}, path, 1, "2024-01-01 00:00:00", sets={"alike": sets["alike"]})
    assert read_changes(spark, path, staged.schema).count() == 5
    empty = {r.rule: r.failures for r in publish.audit_sets(staged.limit(0), {}, sets).collect()}
    assert empty == {"twice": 0, "parent": 0, "held": 0, "less": 1, "alike": 1}
