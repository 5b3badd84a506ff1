"""Long-format tables from the node table: fields, logs and detector events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.functions.paths import file_name
from tablework.functions.times import run_time
from tablework.functions.values import as_texts, unwrapped_text

# Run-level fields.
RUN_FIELDS = (
    "definition",
    "duration",
    "end_time",
    "entry_identifier",
    "experiment_identifier",
    "experiment_title",
    "notes",
    "proton_charge",
    "raw_frames",
    "run_number",
    "start_time",
    "title",
    "total_counts",
    "total_other_counts",
    "total_uncounted_counts",
)

#: Elements of a cell, in which parallel arrays meet whatever their chunks are.
CELL = 10_000
#: Points of one log that share a copy of the log's facts.
POINTS_PER_SLICE = 1_000_000


def element_texts() -> Column:
    """Elements of a dataset as text, whatever their type."""
    return F.coalesce(F.col("str_values"), as_texts("int_values"), as_texts("dbl_values"))


def element_doubles() -> Column:
    return F.coalesce(
        F.col("dbl_values"),
        F.transform("int_values", lambda v: v.cast("double")),
        F.transform("str_values", lambda v: v.try_cast("double")),
    )


def whole(rows: DataFrame) -> DataFrame:
    """One row per node: the elements of all its chunks in order, other columns of its first chunk.

    For named fields, whose elements fit a row; logs and events stay in chunks.
    """
    values = ("str_values", "int_values", "dbl_values")
    keys = ("file_path", "node_path")
    others = [c for c in rows.columns if c not in (*values, *keys, "chunk_offset")]

    def all_of(name: str) -> Column:
        chunks = F.collect_list(F.when(F.col(name).isNotNull(), F.struct("chunk_offset", F.col(name).alias("v"))))
        return F.when(F.count(name) > 0, F.flatten(F.transform(F.array_sort(chunks), lambda c: c["v"])))

    first = F.min_by(F.struct(*others), F.col("chunk_offset"))
    gathered = rows.groupBy(*keys).agg(
        first.alias("__first"), F.min("chunk_offset").alias("chunk_offset"), *[all_of(v).alias(v) for v in values]
    )
    return gathered.select(
        *[F.col(f"__first.{c}").alias(c) if c in others else F.col(c) for c in rows.columns]
    )


def field_text() -> Column:
    """NULL when empty, the value when single, list text when several."""
    return unwrapped_text(element_texts())


def _datasets(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("kind") == "dataset")


def _field_rows(datasets: DataFrame, group: Column, field: Column) -> DataFrame:
    """One row per field with its whole value, however it is stored."""
    return whole(datasets).select(
        "file_path",
        group.alias("group"),
        field.alias("field"),
        "chunk_offset",
        field_text().alias("value"),
    )


def group_names(nodes: DataFrame, parent: str) -> DataFrame:
    """The groups below ``parent`` of each file in the order of their names, from 0."""
    ordered = Window.partitionBy("file_path").orderBy("name")
    groups = nodes.where((F.col("kind") == "group") & (F.col("parent_path") == parent))
    return groups.select("file_path", "name", (F.row_number().over(ordered) - 1).alias("position"))


def sample_fields(nodes: DataFrame, entry: str = "entry") -> DataFrame:
    parent = f"{entry}/sample"
    rows = _datasets(nodes).where(F.col("parent_path") == parent)
    return _field_rows(rows, F.lit("sample"), F.col("name"))


def instrument_fields(nodes: DataFrame, entry: str = "entry") -> DataFrame:
    """Fields of the instrument and, prefixed, of its one nested description."""
    parent, nested = f"{entry}/instrument", f"{entry}/instrument/instrument_xml"
    rows = _datasets(nodes).where(F.col("parent_path").isin(parent, nested))
    name = F.when(
        F.col("parent_path") == nested, F.concat(F.lit("instrument_xml_"), F.col("name"))
    ).otherwise(F.col("name"))
    return _field_rows(rows, F.lit("instrument"), name)


def user_rows(nodes: DataFrame, entry: str = "entry") -> DataFrame:
    """Fields of every user group; ``group`` is the user id."""
    return _child_fields(nodes, entry, lambda name: name.startswith("user"))


def software_rows(nodes: DataFrame, entry: str = "entry") -> DataFrame:
    """Fields of every software component; ``group`` is the component."""
    return _child_fields(nodes, f"{entry}/Software", lambda name: F.lit(True))


def _child_fields(nodes: DataFrame, root: str, wanted) -> DataFrame:
    group = F.substring_index("parent_path", "/", -1)
    rows = _datasets(nodes).where(
        F.col("parent_path").startswith(f"{root}/")
        & (F.col("parent_path") == F.concat(F.lit(f"{root}/"), group))
        & wanted(group)
    )
    return _field_rows(rows, group, F.col("name"))


def wide_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Chosen fields as columns, one row per group; the list keeps this one pass."""
    return rows.groupBy("file_path", "group").agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    )


def run_metadata(
    nodes: DataFrame, entry: str = "entry", now: Column | str | None = None
) -> DataFrame:
    """Run-level fields plus file and entry attributes, one row per file."""
    field = (F.col("kind") == "dataset") & (F.col("parent_path") == entry)
    root, is_entry = F.col("kind") == "file", (F.col("node_path") == entry) & (F.col("kind") == "group")
    rows = whole(nodes.where(root | is_entry | (field & F.col("name").isin(*RUN_FIELDS))))
    found = F.max(is_entry.cast("int")) == 1
    values = rows.groupBy("file_path").agg(
        found.alias("has_entry"),
        *[F.max(F.when(field & (F.col("name") == f), field_text())).alias(f) for f in RUN_FIELDS],
        F.first(F.when(root, F.col("attrs")), ignorenulls=True).alias("file_attrs"),
        F.first(F.when(is_entry, F.col("attrs")), ignorenulls=True).alias("entry_attrs"),
    )
    return values.select(
        *RUN_FIELDS,
        F.when(F.col("has_entry"), F.col("file_attrs")).alias("file_attrs"),
        "entry_attrs",
        file_name("file_path").alias("source_file"),
        F.col("file_path").alias("source_path"),
        run_time(now).alias("ingestion_time"),
    )


def attribute_rows(nodes: DataFrame) -> DataFrame:
    """File and entry attributes in long form, under their prefixed names."""
    prefix = F.when(F.col("kind") == "file", F.lit("file_attr_")).when(
        (F.col("kind") == "group") & (F.col("depth") == 1), F.lit("entry_attr_")
    )
    return (
        nodes.where(F.col("kind").isin("file", "group") & (F.col("depth") <= 1))
        .select("file_path", prefix.alias("prefix"), F.explode("attrs").alias("name", "value"))
        .where(F.col("prefix").isNotNull())
        .select("file_path", F.concat("prefix", "name").alias("attribute"), "value")
    )


def in_cells(chunks: DataFrame, cell: int = CELL) -> DataFrame:
    """Chunks cut at multiples of ``cell``: adds ``cell`` and ``start``, the place of the first element.

    Parallel datasets may be chunked at different positions; cut at common
    ones, their pieces can be grouped and lined up. A chunk inside one cell is
    passed on as it is.
    """
    values = ("str_values", "int_values", "dbl_values")
    length = F.coalesce(*[F.when(F.col(v).isNotNull(), F.size(v)) for v in values])
    size = F.lit(cell).cast("bigint")
    low, high = F.floor(F.col("chunk_offset") / size), F.floor((F.col("chunk_offset") + F.col("__length") - 1) / size)
    cut = (
        chunks.withColumn("__length", length)
        .where(F.col("__length") > 0)
        .withColumn("cell", F.explode(F.sequence(low, high)))
        .withColumn("__from", F.greatest(F.col("cell") * size - F.col("chunk_offset"), F.lit(0)).cast("int"))
        .withColumn("__to", F.least((F.col("cell") + 1) * size - F.col("chunk_offset"), F.col("__length")).cast("int"))
    )
    inside = (F.col("__from") == 0) & (F.col("__to") == F.col("__length"))
    pieces = {
        v: F.when(inside, F.col(v)).otherwise(F.slice(v, F.col("__from") + 1, F.col("__to") - F.col("__from"))) for v in values
    }
    return cut.withColumns({**pieces, "start": F.col("chunk_offset") + F.col("__from")}).drop("__length", "__from", "__to")


def _lined_up(name: str, column: str) -> Column:
    """The pieces of one dataset in a cell as one array, NULL without any; typed, as stored."""
    mine = (F.col("name") == name) & F.col(column).isNotNull()
    pieces = F.collect_list(F.when(mine, F.struct("start", F.col(column).alias("v"))))
    return F.when(F.count_if(mine) > 0, F.flatten(F.transform(F.array_sort(pieces), lambda p: p["v"])))


def _doubles(prefix: str) -> Column:
    return F.coalesce(
        F.col(f"{prefix}_dbl"),
        F.transform(f"{prefix}_int", lambda v: v.cast("double")),
        F.transform(f"{prefix}_str", lambda v: v.try_cast("double")),
    )


def _arrays(name: str, prefix: str) -> list[Column]:
    return [_lined_up(name, f"{kind}_values").alias(f"{prefix}_{kind}") for kind in ("str", "int", "dbl")]


#: Series of a log, and single values that describe it.
SERIES = ("time", "value", "veto_pulse_time")
LOG_FACTS = ("device_name", "device_id", "average_value", "minimum_value", "maximum_value")
_VALUES = ("str_values", "int_values", "dbl_values")


def _below_logs(nodes: DataFrame, entry: str) -> DataFrame:
    """Datasets of the logs of an entry, with the path of their log."""
    root = f"{entry}/DASlogs"
    under = F.col("parent_path") == F.concat(
        F.lit(f"{root}/"), F.substring_index("parent_path", "/", -1)
    )
    found = nodes.where((F.col("kind") == "dataset") & F.col("parent_path").startswith(f"{root}/") & under)
    return found.withColumnRenamed("parent_path", "log_path")


def _head_nodes(entry: str) -> Column:
    """Nodes that tell what a log is: its group, its single values, and the first chunk of its series."""
    root = f"{entry}/DASlogs"
    under = F.col("parent_path").startswith(f"{root}/")
    series = F.col("name").isin(*SERIES) & (F.col("chunk_offset") == 0)
    return ((F.col("kind") == "group") & (F.col("parent_path") == root)) | (
        (F.col("kind") == "dataset") & under & (F.col("name").isin(*LOG_FACTS) | series)
    )


def log_heads(nodes: DataFrame, entry: str = "entry") -> DataFrame:
    """One row per log: its facts, the length of its series, and how many points it has.

    One scan: groups, single values and the sizes of series are told apart after it.
    """
    root = f"{entry}/DASlogs"
    is_group, is_series = F.col("kind") == "group", F.col("name").isin(*SERIES)
    log = F.when(is_group, F.col("node_path")).otherwise(F.col("parent_path"))
    # The arrays of series stay behind; their sizes are columns of their own.
    found = nodes.where(_head_nodes(entry)).withColumns({v: F.when(~is_series, F.col(v)) for v in _VALUES})
    rows = (
        whole(found)
        .withColumn("log_path", log)
        .where(is_group | (F.col("log_path") == F.concat(F.lit(f"{root}/"), F.substring_index("log_path", "/", -1))))
        .select(
            "file_path",
            "log_path",
            F.when(~is_group, F.col("name")).alias("name"),
            "size",
            F.when(~is_group & ~is_series, field_text()).alias("text"),
            is_group.alias("is_group"),
        )
    )

    def fact(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("text")))

    def points(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("size")))

    n_time, n_value, n_veto = F.col("n_time"), F.col("n_value"), F.col("n_veto")
    return (
        rows.groupBy("file_path", "log_path")
        .agg(
            fact("device_name").alias("device_name"),
            fact("device_id").alias("device_id"),
            fact("average_value").try_cast("double").alias("average_value"),
            fact("minimum_value").try_cast("double").alias("min_value"),
            fact("maximum_value").try_cast("double").alias("max_value"),
            points("time").alias("n_time"),
            points("value").alias("n_value"),
            points("veto_pulse_time").alias("n_veto"),
        )
        .withColumn(
            "n_points",
            F.when(n_time.isNotNull() & n_value.isNotNull(), F.least(n_time, n_value)).when(
                n_time.isNull() & n_veto.isNotNull(), n_veto
            ),
        )
        .withColumn("pulses", n_time.isNull() & n_veto.isNotNull())
    )


def daslog_rows(
    nodes: DataFrame,
    entry: str = "entry",
    points_per_slice: int = POINTS_PER_SLICE,
    heads: DataFrame | None = None,
    typed: bool = False,
) -> DataFrame:
    """One row per point of every log; a log without a series keeps one row.

    Time and value chunks of a log are cut at common positions and meet in one
    grouping per cell, as typed arrays; they become text after that. The facts of a log are copied once per
    ``points_per_slice`` points, so a log with a third of all points is joined
    in many equal slices. ``heads`` are the log heads if they are at hand.

    With ``typed`` each point also has ``typed``, its value as a VARIANT that
    keeps the type it was stored with.
    """
    heads = log_heads(nodes, entry) if heads is None else heads
    data = _below_logs(nodes, entry)
    columns = ["device_name", "device_id", "average_value", "min_value", "max_value"]

    last = F.floor(F.greatest(F.col("n_points") - 1, F.lit(0)) / points_per_slice)
    sliced = heads.where(F.col("n_points") > 0).select(
        "file_path", "log_path", "pulses", *columns,
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("slice"),
    )
    as_variants = lambda c: F.transform(c, lambda v: v.cast("variant"))
    variants = F.coalesce(as_variants("value_str"), as_variants("value_int"), as_variants("value_dbl"))
    pulse = F.when(F.col("pulse_dbl").isNotNull(), F.lit(1.0).cast("variant")).otherwise(F.lit(1).cast("bigint").cast("variant"))
    chunks = (
        in_cells(data.where(F.col("name").isin(*SERIES)))
        .groupBy("file_path", "log_path", "cell")
        .agg(*_arrays("time", "time"), *_arrays("value", "value"), *_arrays("veto_pulse_time", "pulse"))
        .select(
            "file_path",
            "log_path",
            (F.col("cell") * CELL).alias("chunk_offset"),
            _doubles("time").alias("t"),
            F.coalesce(F.col("value_str"), as_texts("value_int"), as_texts("value_dbl")).alias("v"),
            _doubles("pulse").alias("pulse_t"),
            F.when(F.col("pulse_dbl").isNotNull(), F.lit("1.0")).otherwise(F.lit("1")).alias("pulse_v"),
            *([variants.alias("w"), pulse.alias("pulse_w")] if typed else []),
        )
        .withColumn("slice", F.floor(F.col("chunk_offset") / points_per_slice))
    )

    def repeated(pulse_value: str, value: str) -> Column:
        return F.when(F.col("pulses"), F.array_repeat(F.col(pulse_value), F.size("pulse_t"))).otherwise(F.col(value))

    joined = chunks.join(sliced, ["file_path", "log_path", "slice"]).select(
        "file_path",
        "log_path",
        "chunk_offset",
        *columns,
        F.when(F.col("pulses"), F.col("pulse_t")).otherwise(F.col("t")).alias("t"),
        repeated("pulse_v", "v").alias("v"),
        *([repeated("pulse_w", "w").alias("w")] if typed else []),
    )
    # All sides are cut to the shorter one first; zipping would pad with NULL.
    shorter = F.least(F.size("t"), F.size("v"))
    cut = [F.slice(c, F.lit(1), shorter).alias(c) for c in ("t", "v", *(["w"] if typed else []))]
    exploded = joined.where(shorter > 0).select(
        "file_path",
        F.substring_index("log_path", "/", -1).alias("log_name"),
        *columns,
        "chunk_offset",
        F.posexplode(F.arrays_zip(*cut)).alias("pos", "point"),
    )
    layout = ["file_path", "log_name", "point_idx", "device_name", "device_id", "time", "value"]
    layout += ["average_value", "min_value", "max_value", *(["typed"] if typed else [])]
    variant = {"typed": F.col("point.w")} if typed else {}
    with_series = exploded.withColumns(
        {
            "point_idx": F.col("chunk_offset") + F.col("pos"),
            "time": F.col("point.t"),
            "value": F.col("point.v"),
            **variant,
        }
    ).select(*layout)
    bare = heads.where(F.col("n_points").isNull()).withColumns(
        {
            "log_name": F.substring_index("log_path", "/", -1),
            "point_idx": F.lit(None).cast("bigint"),
            "time": F.lit(None).cast("double"),
            "value": F.lit(None).cast("string"),
            **({"typed": F.lit(None).cast("variant")} if typed else {}),
        }
    ).select(*layout)
    return with_series.unionByName(bare)


def _banks(nodes: DataFrame, entry: str) -> DataFrame:
    """Datasets of event banks and monitors, with the bank's name."""
    bank = F.substring_index("parent_path", "/", -1)
    return (
        _datasets(nodes)
        .where(
            F.col("parent_path").startswith(f"{entry}/")
            & (F.col("parent_path") == F.concat(F.lit(f"{entry}/"), bank))
            & (bank.contains("_events") | bank.startswith("monitor"))
        )
        .withColumn("bank", bank)
    )


def event_rows(
    nodes: DataFrame, entry: str = "entry", max_events: int | None = None
) -> DataFrame:
    """Detector events of every bank that has ids and time offsets.

    Work is split by chunk, never by bank: chunks are cut at common positions
    and the pieces of a cell unfold in place. Node tables that were stored
    aligned skip the cutting and keep their bucketing. ``max_events`` (None or 0
    for all) keeps the first events of each bank and skips chunks beyond it.
    """
    chunks = _banks(nodes, entry).where(F.col("name").isin("event_id", "event_time_offset"))
    if max_events:
        chunks = chunks.where(F.col("chunk_offset") < max_events)
    if "aligned" in nodes.columns:
        chunks = chunks.withColumn("start", F.col("chunk_offset"))
        keys, at = ["file_path", "parent_path", "chunk_offset"], F.col("chunk_offset")
    else:
        chunks = in_cells(chunks)
        keys, at = ["file_path", "parent_path", "cell"], F.col("cell") * CELL
    ids = F.coalesce(F.col("ids_int"), F.transform("ids_dbl", lambda v: v.cast("bigint")))
    pairs = (
        chunks.groupBy(*keys)
        .agg(*_arrays("event_id", "ids"), *_arrays("event_time_offset", "offsets"))
        .select("file_path", "parent_path", at.alias("chunk_offset"), ids.alias("i"), _doubles("offsets").alias("t"))
        .withColumn("n", F.least(F.size("i"), F.size("t")))
        .where(F.col("i").isNotNull() & F.col("t").isNotNull() & (F.col("n") > 0))
    )
    rows = pairs.select(
        "file_path",
        F.substring_index("parent_path", "/", -1).alias("bank"),
        "chunk_offset",
        F.posexplode(
            F.arrays_zip(F.slice("i", F.lit(1), F.col("n")).alias("i"), F.slice("t", F.lit(1), F.col("n")).alias("t"))
        ).alias("pos", "event"),
    ).select(
        "file_path",
        "bank",
        (F.col("chunk_offset") + F.col("pos")).alias("event_idx"),
        F.col("event.i").alias("event_id"),
        F.col("event.t").alias("time_offset"),
    )
    return rows.where(F.col("event_idx") < max_events) if max_events else rows


def bank_summary(
    nodes: DataFrame, entry: str = "entry", max_events: int | None = None
) -> DataFrame:
    """Counts of every bank with ids or offsets, read from dataset sizes alone."""
    banks = _banks(nodes, entry)
    rows = banks.where(F.col("chunk_offset") == 0)

    def size_of(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("size")))

    sizes = rows.where(
        F.col("name").isin("event_id", "event_time_offset", "event_index")
    ).select("file_path", "bank", "name", "size", F.lit(None).cast("bigint").alias("total"))
    totals = whole(banks.where(F.col("name") == "total_counts")).select(
        "file_path",
        "bank",
        "name",
        F.lit(None).cast("bigint").alias("size"),
        field_text().try_cast("bigint").alias("total"),
    )
    extracted = F.when(
        F.col("n_ids").isNotNull() & F.col("n_offsets").isNotNull(),
        F.least(F.col("n_ids"), F.col("n_offsets")),
    ).otherwise(F.lit(0).cast("bigint"))
    if max_events:
        extracted = F.least(extracted, F.lit(max_events).cast("bigint"))
    return (
        sizes.unionByName(totals)
        .groupBy("file_path", "bank")
        .agg(
            F.max("total").alias("total_counts"),
            F.coalesce(size_of("event_index"), F.lit(0).cast("bigint")).alias("n_pulses"),
            size_of("event_id").alias("n_ids"),
            size_of("event_time_offset").alias("n_offsets"),
        )
        .where(F.col("n_ids").isNotNull() | F.col("n_offsets").isNotNull())
        .select("file_path", "bank", "total_counts", "n_pulses", extracted.alias("events_extracted"))
    )


def small_nodes(nodes: DataFrame, entry: str = "entry") -> DataFrame:
    """Every node that category tables need besides the points of logs and the events.

    Named fields are gathered whole; series and event datasets keep their size
    and lose their arrays. The result is a node table itself, small beside the
    one it comes from, and takes one scan of it.
    """
    parent, name, depth = F.col("parent_path"), F.col("name"), F.col("depth")
    dataset = F.col("kind") == "dataset"
    group = F.substring_index("parent_path", "/", -1)
    child = parent == F.concat(F.lit(f"{entry}/"), group)
    fields = (
        ((parent == entry) & name.isin(*RUN_FIELDS))
        | parent.isin(f"{entry}/sample", f"{entry}/instrument", f"{entry}/instrument/instrument_xml")
        | (child & group.startswith("user"))
        | (parent == F.concat(F.lit(f"{entry}/Software/"), group))
    )
    bank = child & (group.contains("_events") | group.startswith("monitor"))
    sizes = bank & name.isin("event_id", "event_time_offset", "event_index") & (F.col("chunk_offset") == 0)
    counts = bank & (name == "total_counts")
    heads = _head_nodes(entry)
    roots = (F.col("kind") == "file") | ((F.col("kind") == "group") & (depth == 1))
    bulky = dataset & (sizes | (heads & name.isin(*SERIES)))
    wanted = nodes.where(roots | heads | (dataset & (fields | sizes | counts)))
    # Only what is named is gathered, so event and log arrays never meet in one row.
    return whole(wanted.withColumns({v: F.when(~bulky, F.col(v)) for v in _VALUES}))


def category_fields(nodes: DataFrame, entry: str = "entry") -> DataFrame:
    """Fields of samples, instruments, users and software in one pass, tagged with their ``category``."""
    parent, name = F.col("parent_path"), F.col("name")
    group = F.substring_index("parent_path", "/", -1)
    nested = f"{entry}/instrument/instrument_xml"
    category = (
        F.when(parent == f"{entry}/sample", "sample")
        .when(parent.isin(f"{entry}/instrument", nested), "instrument")
        .when((parent == F.concat(F.lit(f"{entry}/"), group)) & group.startswith("user"), "users")
        .when(parent == F.concat(F.lit(f"{entry}/Software/"), group), "software")
    )
    tagged = _datasets(nodes).withColumn("category", category).where(F.col("category").isNotNull())
    alone = F.col("category").isin("sample", "instrument")
    return whole(tagged).select(
        "category",
        "file_path",
        F.when(alone, F.col("category")).otherwise(group).alias("group"),
        F.when(parent == nested, F.concat(F.lit("instrument_xml_"), name)).otherwise(name).alias("field"),
        "chunk_offset",
        field_text().alias("value"),
    )


#: Datasets that are read in parallel.
PARALLEL = ("event_id", "event_time_offset", "time", "value", "veto_pulse_time")


def aligned(nodes: DataFrame, cell: int = CELL) -> DataFrame:
    """The node table with parallel datasets chunked at common positions, marked ``aligned``."""
    parallel = F.coalesce((F.col("kind") == "dataset") & F.col("name").isin(*PARALLEL) & (F.col("size") > 0), F.lit(False))
    cut = in_cells(nodes.where(parallel), cell)
    keys = ["file_path", "node_path", "cell"]
    values = ("str_values", "int_values", "dbl_values")
    others = [c for c in nodes.columns if c not in (*values, *keys, "chunk_offset")]
    together = cut.groupBy(*keys).agg(
        F.min_by(F.struct(*others), F.col("start")).alias("__first"),
        *[
            F.when(F.count(v) > 0, F.flatten(F.transform(
                F.array_sort(F.collect_list(F.when(F.col(v).isNotNull(), F.struct("start", F.col(v).alias("v"))))),
                lambda p: p["v"],
            ))).alias(v)
            for v in values
        ],
    )
    placed = together.withColumn("chunk_offset", (F.col("cell") * cell).cast(nodes.schema["chunk_offset"].dataType)).select(
        *[F.col(f"__first.{c}").alias(c) if c in others else F.col(c) for c in nodes.columns]
    )
    return nodes.where(~parallel).unionByName(placed).withColumn("aligned", F.lit(True))


def misaligned_chunks(nodes: DataFrame) -> DataFrame:
    """Chunk positions where parallel datasets of a group do not meet.

    Empty for a table that :func:`aligned` has stored. Ids and offsets, or times and values, must
    share their positions up to the end of the shorter dataset.
    """
    pairs = {"event_id": "events", "event_time_offset": "events", "time": "log", "value": "log"}
    kind = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])[F.col("name")]
    rows = _datasets(nodes).where(F.col("name").isin(*pairs)).select(
        "file_path", "parent_path", "name", kind.alias("pair"), "chunk_offset", "size"
    )
    extent = rows.groupBy("file_path", "parent_path", "pair").agg(
        F.count_distinct("name").alias("parts"), F.min("size").alias("shorter")
    )
    met = rows.groupBy("file_path", "parent_path", "pair", "chunk_offset").agg(
        F.count(F.lit(1)).alias("found")
    )
    return (
        met.where(F.col("found") != 2)
        .join(extent.where(F.col("parts") == 2), ["file_path", "parent_path", "pair"])
        .where(F.col("chunk_offset") < F.col("shorter"))
        .select("file_path", "parent_path", "chunk_offset", "found")
    )
