"""Alignment, listings, catalog and long tables on hand-written rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tablework.functions.paths import (
    file_extension,
    file_name,
    has_science_extension,
    location_uri,
    output_base_name,
    safe_key,
    stem,
)
from tablework.functions.values import joined_text, number_text, unwrapped, unwrapped_text
from tablework.operators import nexus
from tablework.operators.align import align
from tablework.operators.catalog import (
    entry_metadata,
    file_metadata,
    files_by_instrument,
    files_of_instrument,
    node_counts,
    significant_json,
    to_catalog,
)
from tablework.operators.registry import registry_by_extension, registry_rows, registry_totals
from tablework.plans import inventory, science
from tablework.runtime import scratch_path
from tablework.schemas import FILE_METADATA, H5_CATALOG, H5_NODES
from tablework.sinks.tables import (
    append,
    create_catalog_table,
    create_namespace,
    create_orders_table,
    create_registry_table,
    write_categories,
    write_manifest,
    write_node_table,
    write_nodes,
    write_snapshot,
)
from tablework.sources.files import LISTING, list_files, list_prefix, list_science_files
from tablework.sources.tables import read_category, read_drifting, read_nodes

NOW = "2024-05-01 12:00:00"


def texts(spark, values, *columns):
    df = spark.createDataFrame([(v,) for v in values], "p string")
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_paths(spark):
    paths = ["/a/v1.2/README", "/a/x.nxs.h5", "/a/.hidden", "/a/dir/", "b.H5", "/a/.h5"]
    assert texts(spark, paths, file_name("p")) == ["README", "x.nxs.h5", ".hidden", "", "b.H5", ".h5"]
    assert texts(spark, paths, file_extension("p")) == [None, "h5", "hidden", None, "H5", "h5"]
    assert texts(spark, paths, has_science_extension("p")) == [False, True, False, False, True, False]
    assert texts(spark, ["x.nxs.h5", "a-b.c", ".h5", "plain"], safe_key(stem("p"))) == [
        "x_nxs", "a_b", "_h5", "plain",
    ]
    assert texts(spark, ["/r/REF_1.nxs.h5", "/r/y.h5.hdf5"], output_base_name("p")) == ["REF_1", "y"]
    assert texts(spark, ["/a", "file:///a", "s3://b/k", "", None], location_uri("p", F.lit("/fall"))) == [
        "file:///a", "file:///a", "s3://b/k", "file:///fall", "file:///fall",
    ]


def test_array_decoding(spark):
    df = spark.createDataFrame(
        [([], [], []), (["a"], [1], [1.5]), (["a", "", None, "b"], [1, 2], [1.0, 2.5])],
        "s array<string>, i array<bigint>, d array<double>",
    )
    assert [r[0] for r in df.select(joined_text("s")).collect()] == ["", "a", "a, b"]
    assert [r[0] for r in df.select(number_text("i")).collect()] == ["", "1", "[1, 2]"]
    assert [r[0] for r in df.select(number_text("d")).collect()] == ["", "1.5", "[1.0, 2.5]"]
    assert [r[0] for r in df.select(unwrapped("i")).collect()] == [None, 1, None]
    assert [r[0] for r in df.select(unwrapped_text("i")).collect()] == [None, "1", "[1, 2]"]


def test_align(spark):
    df = spark.createDataFrame(
        [("/a", "12", "[1.0, 2.0]", ["x", "y"], "2024-01-02T03:04:05", 7)],
        "file_path string, file_size_bytes string, duration string, title array<string>,"
        " ingestion_time string, group_count bigint",
    )
    found = to_catalog(df, NOW)
    assert found.schema.fieldNames() == H5_CATALOG.fieldNames() and len(found.columns) == 32
    assert [f.dataType for f in found.schema] == [f.dataType for f in H5_CATALOG]
    row = found.first()
    assert (row["file_size_bytes"], row["duration"], row["title"], row["group_count"]) == (12, None, "[x, y]", 7)
    assert row["ingestion_time"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert row["cataloged_at"] == dt.datetime(2024, 5, 1, 12) and row["s3_uri"] is None
    assert len(align(df, FILE_METADATA).columns) == 30


def test_listing_skips_contents_and_missing_roots(spark, tmp_path, plan):
    for name in ("a.h5", "sub/b.NXS", "sub/c.txt", "sub/noext"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    listing = list_files(spark, str(tmp_path))
    assert listing.count() == 4 and listing.agg(F.sum("length")).first()[0] == 20
    assert "content" not in plan(listing).split("ReadSchema")[1]
    assert list_files(spark, str(tmp_path / "none")) is None
    found = list_science_files(spark, [str(tmp_path), str(tmp_path / "none")])
    assert sorted(r["path"].rsplit("/", 1)[1] for r in found.collect()) == ["a.h5", "b.NXS"]
    assert list_prefix(listing, f"file:{tmp_path}/sub", 2).count() == 2

    space = "files_test"
    create_namespace(spark, space)
    create_registry_table(spark, f"{space}.registry", scratch_path(spark, "registry"))
    assert inventory.register(spark, str(tmp_path), f"{space}.registry", NOW)
    assert inventory.register(spark, str(tmp_path), f"{space}.registry", NOW)
    assert not inventory.register(spark, str(tmp_path / "none"), f"{space}.registry", NOW)
    assert spark.table(f"{space}.registry").count() == 8
    assert inventory.register(spark, str(tmp_path), f"{space}.registry", NOW, mode="new_only")
    registry = spark.table(f"{space}.registry")
    assert registry.count() == 8
    totals = registry_totals(registry).first()
    assert (totals["total_files"], totals["total_bytes"], totals["unique_extensions"]) == (8, 40, 3)
    assert registry_by_extension(registry).first()["count"] == 2


def test_registry_of_nothing(spark):
    empty = registry_rows(spark.createDataFrame([], LISTING), NOW)
    assert registry_totals(empty).first().asDict() == {
        "total_files": 0, "total_bytes": 0, "unique_extensions": 0,
    }


def test_tables(spark):
    create_namespace(spark, "tables_test")
    create_orders_table(spark, "tables_test.orders", scratch_path(spark, "orders"))
    create_catalog_table(spark, "tables_test.catalog", scratch_path(spark, "catalog"))
    create_catalog_table(spark, "tables_test.catalog")
    assert len(spark.table("tables_test.orders").columns) == 10
    rows = to_catalog(
        spark.createDataFrame([("/a", "x"), ("/b", None)], "file_path string, instrument_name string"), NOW
    )
    append(rows, "tables_test.catalog")
    found = spark.table("tables_test.catalog")
    assert found.count() == 2 and len(found.columns) == 32
    assert files_of_instrument(found, "x").count() == 1


def test_run_files_unfold_in_tasks_of_bounded_size(spark, tmp_path):
    from tablework.queries.fixtures import RUNS_PER_TASK, run_nodes

    rows = spark.range(3 * RUNS_PER_TASK).selectExpr(
        "id AS s_suppkey", "'name ' || id AS s_name", "CAST(id % 25 AS int) AS s_nationkey", "CAST(id AS double) AS s_acctbal"
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    files = run_nodes(spark, str(tmp_path)).where("kind = 'file'").groupBy(F.spark_partition_id()).count()
    held = [r["count"] for r in files.collect()]
    assert sum(held) == 3 * RUNS_PER_TASK and max(held) <= RUNS_PER_TASK


def test_instrument_groups_keep_blank_and_missing_apart(spark):
    rows = [("/a", "", 1 << 20), ("/b", None, 2 << 20), ("/c", "x", 0), ("/d", "x", None)]
    df = spark.createDataFrame(rows, "file_path string, instrument_name string, file_size_bytes bigint")
    found = [(r["instrument"], r["file_count"], r["total_size_mb"]) for r in files_by_instrument(df).collect()]
    assert found == [("x", 2, 0.0), ("", 1, 1.0), ("Unknown", 1, 2.0)]


def test_catalog_merge_of_drifting_snapshots(spark):
    root = scratch_path(spark, "snapshots")
    first = spark.createDataFrame(
        [("/a", 1, "2024-01-01T00:00:00", "t1"), ("/b", 1, "2024-01-01T00:00:00", "t1")],
        "file_path string, file_size_bytes bigint, ingestion_time string, title string",
    )
    second = spark.createDataFrame(
        [("/a", "2", "2024-01-03T00:00:00", 3.5), ("/a", "3", "2024-01-02T00:00:00", None)],
        "file_path string, file_size_bytes string, ingestion_time string, duration double",
    )
    paths = [write_snapshot(first, root, "1"), write_snapshot(second, root, "2")]
    assert read_drifting(spark, paths, FILE_METADATA).count() == 4
    empty = spark.createDataFrame([], H5_CATALOG)
    merged = science.merge_snapshots(spark, empty, paths, NOW)
    assert {r["file_path"]: r["file_size_bytes"] for r in merged.collect()} == {"/a": 2, "/b": 1}
    assert science.summary(merged)["recent"].count() == 2


def nodes(spark, rows):
    """(file, path, kind, attrs, values, size or None, chunk)"""
    out = []
    for order, (file, path, kind, attrs, values, size, chunk) in enumerate(rows):
        parent, _, name = path.rpartition("/")
        kinds = [None, None, None]
        if values is not None:
            first = values[0] if values else 0
            slot = 0 if isinstance(first, str) else 1 if isinstance(first, int) else 2
            kinds[slot] = values
        if size is None:
            size = len(values or [])
        depth = 0 if path == "" else path.count("/") + 1
        out.append((file, path, parent, name, depth, order, kind, attrs or {}, "", [size], size, chunk, *kinds))
    return spark.createDataFrame(out, H5_NODES)


def g(path, nx=None, file="/f.h5"):
    return (file, path, "group", {"NX_class": nx} if nx else None, None, 0, 0)


def d(path, values, size=None, chunk=0, file="/f.h5"):
    return (file, path, "dataset", None, values, size, chunk)


def test_entry_metadata_rules(spark):
    table = nodes(
        spark,
        [
            ("/f.h5", "", "file", {"driver": "sec2"}, None, 0, 0),
            g("aaa"),
            d("aaa/title", ["not an entry"]),
            g("raw", "NXentry"),
            d("raw/duration", [1.0, 2.0]),
            d("raw/title", ["first", "", "part"]),
            g("raw/Instrument_A", "NXinstrument"),
            g("raw/Instrument_A/s1", "NXsource"),
            d("raw/Instrument_A/s1/name", ["one"]),
            d("raw/Instrument_A/s1/type", ["t1"]),
            g("raw/Instrument_A/s2", "NXsource"),
            d("raw/Instrument_A/s2/name", ["two"]),
            g("raw/instrument_b"),
            d("raw/instrument_b/name", ["ignored"]),
            g("raw/user"),
            g("zentry"),
            ("/e.h5", "entry", "group", None, None, 0, 0),
            ("/g.h5", "other", "group", None, None, 0, 0),
        ],
    )
    found = {r["file_path"]: r.asDict() for r in entry_metadata(table).collect()}
    row = found["/f.h5"]
    assert row["entry_name"] == "raw" and row["title"] == "first, part" and row["duration"] == "[1.0, 2.0]"
    assert (row["instrument_name"], row["instrument_type"]) == ("", "NXinstrument")
    assert (row["source_name"], row["source_type"]) == ("two", "")
    assert row["sample_name"] is None and row["user_name"] == "" and row["start_time"] == ""
    blank = found["/e.h5"]
    assert blank["entry_name"] == "entry" and blank["duration"] == "0" and blank["instrument_name"] is None
    assert "/g.h5" not in found


def test_file_metadata_keeps_failed_files(spark):
    table = nodes(
        spark,
        [
            ("/f.h5", "", "file", {"driver": "sec2", "libver": "v1"}, None, 0, 0),
            g("entry"),
            d("entry/big", list(range(200))),
            d("entry/big", list(range(200)), 400, 200),
            d("entry/small", [1]),
        ],
    )
    listing = spark.createDataFrame(
        [("/f.h5", dt.datetime(2024, 1, 1), 5, None), ("/bad.h5", dt.datetime(2024, 1, 1), 6, "unreadable")],
        LISTING + ", extraction_error string",
    )
    found = {r["file_name"]: r for r in file_metadata(listing, table, NOW).collect()}
    good, bad = found["f.h5"], found["bad.h5"]
    assert (good["group_count"], good["dataset_count"]) == (1, 2)
    assert [x["path"] for x in json.loads(good["significant_datasets"])] == ["entry/big"]
    assert good["file_modified_time"] == "2024-01-01T00:00:00" and good["duration"] == 0.0
    assert bad["extraction_error"] == "unreadable" and bad["group_count"] is None
    assert bad["significant_datasets"] is None and bad["file_size_bytes"] == 6


def test_significant_datasets_are_the_first_ones(spark):
    table = nodes(spark, [d(f"entry/d{i:02d}", None, 50 + i * 5) for i in range(40)])
    listed = json.loads(significant_json(table).first()["significant_datasets"])
    assert [x["path"] for x in listed] == [f"entry/d{i:02d}" for i in range(11, 31)]
    assert node_counts(table).first()["dataset_count"] == 40


def log_nodes(spark, chunk=3):
    times, values = [0.5 * i for i in range(10)], [float(i) for i in range(8)]
    rows = [g("entry"), g("entry/DASlogs")]
    for name in ("temp",):
        path = f"entry/DASlogs/{name}"
        rows.append(g(path))
        rows.append(d(f"{path}/device_name", ["dev"]))
        rows.append(d(f"{path}/average_value", [2.5]))
        rows += [d(f"{path}/time", times[i : i + chunk], 10, i) for i in range(0, 10, chunk)]
        rows += [d(f"{path}/value", values[i : i + chunk], 8, i) for i in range(0, 8, chunk)]
    rows += [
        g("entry/DASlogs/idle"),
        d("entry/DASlogs/idle/device_id", [4]),
        g("entry/DASlogs/halftime"),
        d("entry/DASlogs/halftime/time", [1.0]),
        d("entry/DASlogs/halftime/veto_pulse_time", [1.0]),
        g("entry/DASlogs/veto"),
        d("entry/DASlogs/veto/veto_pulse_time", [1.5, 2.5]),
        d("entry/DASlogs/veto/value", [9.0]),
        g("entry/DASlogs/words"),
        d("entry/DASlogs/words/time", [1, 2]),
        d("entry/DASlogs/words/value", ["on", "off"]),
        g("entry/DASlogs/none"),
        d("entry/DASlogs/none/time", [], 0),
        d("entry/DASlogs/none/value", [], 0),
        d("entry/DASlogs/nested/deep/time", [1.0]),
    ]
    return nodes(spark, rows)


@pytest.mark.parametrize("points_per_slice", [1_000_000, 3])
def test_daslog_rows(spark, points_per_slice):
    found = {}
    for r in nexus.daslog_rows(log_nodes(spark), points_per_slice=points_per_slice).collect():
        found.setdefault(r["log_name"], []).append(r)
    temp = sorted(found["temp"], key=lambda r: r["point_idx"])
    assert [(r["point_idx"], r["time"], r["value"]) for r in temp] == [
        (i, 0.5 * i, str(float(i))) for i in range(8)
    ]
    assert {(r["device_name"], r["average_value"], r["min_value"]) for r in temp} == {("dev", 2.5, None)}
    assert [(r["time"], r["value"], r["device_id"]) for r in found["idle"]] == [(None, None, "4")]
    assert [(r["time"], r["value"]) for r in found["halftime"]] == [(None, None)]
    assert sorted((r["time"], r["value"]) for r in found["veto"]) == [(1.5, "1.0"), (2.5, "1.0")]
    assert sorted((r["time"], r["value"]) for r in found["words"]) == [(1.0, "on"), (2.0, "off")]
    assert set(found) == {"temp", "idle", "halftime", "veto", "words"}


def bank_nodes(spark):
    ids, offsets = list(range(10, 20)), [float(i) for i in range(10)]
    rows = [g("entry"), g("entry/bank1_events")]
    for i in range(0, 10, 4):
        rows.append(d("entry/bank1_events/event_id", ids[i : i + 4], 10, i))
        rows.append(d("entry/bank1_events/event_time_offset", offsets[i : i + 4], 10, i))
    rows += [
        d("entry/bank1_events/event_index", [0, 5], 2),
        d("entry/bank1_events/total_counts", [10]),
        d("entry/monitor1/event_id", [1, 2]),
        d("entry/empty_events/event_id", [], 0),
        d("entry/empty_events/event_time_offset", [], 0),
        d("entry/quiet_events/total_counts", [0]),
        d("entry/sample/event_id", [1]),
        d("entry/sample/event_time_offset", [1.0]),
    ]
    return nodes(spark, rows)


@pytest.mark.parametrize("cap, expected", [(None, 10), (0, 10), (6, 6), (99, 10)])
def test_events_and_summary(spark, cap, expected):
    table = bank_nodes(spark)
    rows = nexus.event_rows(table, max_events=cap).orderBy("event_idx").collect()
    assert [(r["bank"], r["event_idx"], r["event_id"], r["time_offset"]) for r in rows] == [
        ("bank1_events", i, 10 + i, float(i)) for i in range(expected)
    ]
    summary = {r["bank"]: r for r in nexus.bank_summary(table, max_events=cap).collect()}
    assert set(summary) == {"bank1_events", "monitor1", "empty_events"}
    bank = summary["bank1_events"]
    assert (bank["total_counts"], bank["n_pulses"], bank["events_extracted"]) == (10, 2, expected)
    assert sum(r["events_extracted"] for r in summary.values()) == len(rows)


def test_summary_reads_no_event_arrays(spark, plan):
    path = scratch_path(spark, "nodes")
    write_nodes(bank_nodes(spark), path)
    stored = spark.read.parquet(path)
    text = plan(nexus.bank_summary(stored))
    first_scan = text.split("ReadSchema:")[1].split("\n")[0]
    assert "values" not in first_scan


def test_bucketed_nodes_unfold_without_a_shuffle(spark, plan):
    create_namespace(spark, "nodes_test")
    write_node_table(bank_nodes(spark), "nodes_test.h5_nodes", 4, scratch_path(spark, "nodes"))
    rows = nexus.event_rows(spark.table("nodes_test.h5_nodes"))
    assert rows.count() == 10
    assert "Exchange" not in plan(rows, "simple")


def test_misaligned_chunks_are_reported(spark):
    assert nexus.misaligned_chunks(bank_nodes(spark)).isEmpty()
    shifted = nodes(
        spark,
        [
            d("entry/b_events/event_id", [1, 2], 4, 0),
            d("entry/b_events/event_id", [3, 4], 4, 2),
            d("entry/b_events/event_time_offset", [1.0], 4, 0),
            d("entry/b_events/event_time_offset", [2.0, 3.0, 4.0], 4, 1),
        ],
    )
    assert sorted(r["chunk_offset"] for r in nexus.misaligned_chunks(shifted).collect()) == [1, 2]


def test_run_metadata(spark):
    table = nodes(
        spark,
        [
            ("/f.h5", "", "file", {"creator": "me"}, None, 0, 0),
            g("entry", "NXentry"),
            d("entry/title", ["t"]),
            d("entry/notes", []),
            d("entry/raw_frames", [1, 2]),
            ("/g.h5", "", "file", {"creator": "you"}, None, 0, 0),
        ],
    )
    found = {r["source_file"]: r for r in nexus.run_metadata(table, now=NOW).collect()}
    row = found["f.h5"]
    assert (row["title"], row["notes"], row["raw_frames"]) == ("t", None, "[1, 2]")
    assert row["file_attrs"] == {"creator": "me"} and row["entry_attrs"] == {"NX_class": "NXentry"}
    assert found["g.h5"]["file_attrs"] is None and found["g.h5"]["title"] is None


def test_chunked_field_is_shown_whole(spark):
    table = nodes(spark, [g("entry"), d("entry/notes", [3, 4], 4, 2), d("entry/notes", [1, 2], 4, 0)])
    assert nexus.run_metadata(table).first()["notes"] == "[1, 2, 3, 4]"
    sample = nodes(spark, [d("entry/sample/x", [2], 2, 1), d("entry/sample/x", [1], 2, 0)])
    rows = nexus.sample_fields(sample)
    assert [(r["chunk_offset"], r["value"]) for r in rows.collect()] == [(0, "[1, 2]")]
    assert nexus.wide_fields(rows, ["x"]).first()["x"] == "[1, 2]"


def test_chunked_texts_are_shown_whole(spark):
    table = nodes(
        spark,
        [
            g("entry", "NXentry"),
            d("entry/title", ["a", "b"], 4, 0),
            d("entry/title", ["c", "d"], 4, 2),
            g("entry/DASlogs", "NXcollection"),
            g("entry/DASlogs/temp", "NXlog"),
            d("entry/DASlogs/temp/device_name", ["a", "b"], 4, 0),
            d("entry/DASlogs/temp/device_name", ["c", "d"], 4, 2),
        ],
    )
    assert entry_metadata(table).first()["title"] == "a, b, c, d"
    assert nexus.daslog_rows(table).first()["device_name"] == "[a, b, c, d]"


@pytest.mark.parametrize("store", [False, True])
def test_parallel_datasets_meet_under_any_chunking(spark, store):
    rows = [g("entry"), g("entry/DASlogs"), g("entry/DASlogs/temp")]
    rows += [d("entry/b_events/event_id", [1, 2, 3, 4], 4, 0)]
    rows += [d("entry/b_events/event_time_offset", [1.0], 4, 0), d("entry/b_events/event_time_offset", [2.0, 3.0, 4.0], 4, 1)]
    rows += [d("entry/DASlogs/temp/time", [0.0, 1.0, 2.0], 5, 0), d("entry/DASlogs/temp/time", [3.0, 4.0], 5, 3)]
    rows += [d("entry/DASlogs/temp/value", [5, 6], 4, 0), d("entry/DASlogs/temp/value", [7, 8], 4, 2)]
    table = nodes(spark, rows)
    if store:
        table = nexus.aligned(table, 2)
        assert nexus.misaligned_chunks(table).isEmpty()
    found = nexus.event_rows(table).orderBy("event_idx").collect()
    assert [(r["event_idx"], r["event_id"], r["time_offset"]) for r in found] == [(i, i + 1, i + 1.0) for i in range(4)]
    (bank,) = nexus.bank_summary(table).collect()
    assert bank["events_extracted"] == 4
    points = nexus.daslog_rows(table).orderBy("point_idx").collect()
    assert [(r["point_idx"], r["time"], r["value"]) for r in points] == [(i, float(i), str(i + 5)) for i in range(4)]


def test_manifest_file(spark):
    from tablework.operators.catalog import serving_manifest

    row = to_catalog(
        spark.createDataFrame([("/a/x-1.h5", "x-1.h5", "file:///a/x-1.h5")],
                              "file_path string, file_name string, tiled_uri string"), NOW)
    path = scratch_path(spark, "manifest")
    write_manifest(serving_manifest(row), path)
    entry = json.loads(spark.read.text(path).first()[0])
    assert entry["path"] == "x_1_h5" and entry["args"] == {"filepath": "file:///a/x-1.h5"}
    assert entry["metadata"] == {"title": "", "instrument": "", "sample": "", "start_time": ""}


def test_entry_metadata_gathers_named_fields_only(spark, monkeypatch):
    """A large array below the instrument is never gathered to one row."""
    from tablework.operators import catalog

    rows = [g("entry"), g("entry/instrument", "NXinstrument"), d("entry/instrument/name", ["SNAP"]), g("entry/instrument/bank1")]
    rows += [d("entry/instrument/bank1/counts", list(range(1_000)), 3_000, at) for at in (0, 1_000, 2_000)]
    rows += [d("entry/instrument/bank1/name", ["bank"]), g("entry/sample"), d("entry/sample/field", list(range(500)))]
    table = nodes(spark, rows)
    gathered = []

    def whole(found):
        gathered.append(found)
        return nexus.whole(found)

    monkeypatch.setattr(catalog, "whole", whole)
    row = entry_metadata(table).first()
    assert (row["instrument_name"], row["instrument_type"], row["sample_name"]) == ("SNAP", "NXinstrument", "")
    assert {r["name"] for r in gathered[0].collect()} == {"entry", "instrument", "name", "bank1", "sample"}


def test_category_tables_scan_the_nodes_three_times(spark, plan):
    path = scratch_path(spark, "nodes")
    rows = [g("entry"), g("entry/sample"), d("entry/sample/name", ["s"]), g("entry/user1"), d("entry/user1/role", ["r", "q"])]
    rows += [g("entry/DASlogs"), g("entry/DASlogs/temp"), d("entry/DASlogs/temp/time", [0.0, 1.0]), d("entry/DASlogs/temp/value", [5, 6])]
    rows += [g("entry/bank1_events"), d("entry/bank1_events/event_id", [1, 2, 3]), d("entry/bank1_events/event_time_offset", [0.5, 1.5, 2.5])]
    rows += [d("entry/title", ["t"]), g("entry/empty_events"), d("entry/empty_events/event_id", [])]
    write_nodes(nodes(spark, rows), path)
    stored = read_nodes(spark, path)
    small = nexus.small_nodes(stored)
    assert plan(small, "simple").count("FileScan parquet") == 1
    kept = {r["node_path"]: r for r in small.collect()}
    assert kept["entry/bank1_events/event_id"]["int_values"] is None and kept["entry/bank1_events/event_id"]["size"] == 3
    assert plan(nexus.log_heads(stored), "simple").count("FileScan parquet") == 1
    held = scratch_path(spark, "small")
    small.write.parquet(held)
    heads = nexus.log_heads(spark.read.schema(small.schema).parquet(held))
    assert plan(nexus.daslog_rows(stored, heads=heads), "formatted").count(f"[file:{path}]") == 1
    root = scratch_path(spark, "categories")
    counts = write_categories(stored, root, now=NOW)
    assert counts == {"sample": 1, "users": 1, "metadata": 1, "daslogs": 2, "events": 3, "event_summary": 2}
    for name, n in counts.items():
        assert read_category(spark, root, name).count() == n
    users = read_category(spark, root, "users").first()
    assert (users["base_name"], users["group"], users["field"], users["value"]) == ("f", "user1", "role", "[r, q]")


def test_typed_log_values_keep_their_type(spark):
    rows = [g("entry"), g("entry/DASlogs")]
    for log, values in (("whole", [1, 2**60]), ("number", [0.5, 1e16]), ("word", ["on", "7"])):
        rows += [g(f"entry/DASlogs/{log}"), d(f"entry/DASlogs/{log}/time", [0.0, 1.0]), d(f"entry/DASlogs/{log}/value", values)]
    rows += [g("entry/DASlogs/pulse"), d("entry/DASlogs/pulse/veto_pulse_time", [3.0]), g("entry/DASlogs/bare")]
    found = nexus.daslog_rows(nodes(spark, rows), typed=True)
    read = lambda kind: F.try_variant_get("typed", "$", kind)
    seen = found.select("log_name", "point_idx", F.schema_of_variant("typed").alias("kind"), read("bigint").alias("i"), read("double").alias("x"), read("string").alias("s"))
    by_log = {(r.log_name, r.point_idx): r for r in seen.collect()}
    assert [by_log["whole", 1].kind, by_log["whole", 1].i] == ["BIGINT", 2**60]
    assert [by_log["number", 1].kind, by_log["number", 1].x] == ["DOUBLE", 1e16]
    assert [by_log["word", 1].kind, by_log["word", 1].s] == ["STRING", "7"]
    assert by_log["pulse", 0].x == 1.0 and by_log["bare", None].kind is None
    assert "typed" not in nexus.daslog_rows(nodes(spark, rows)).columns
