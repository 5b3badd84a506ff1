"""Schemas of the tables the operators read and write.

The column names and types below are fixed values: existing queries and files
depend on them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_STRING, _INT, _LONG = StringType(), IntegerType(), LongType()
_DOUBLE, _TIME = DoubleType(), TimestampNTZType()


def _table(columns: dict) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Nested order document. `id` carries the document id.
ORDER_DOC = _table(
    {
        "id": _STRING,
        "CustomerId": _STRING,
        "OrderDate": _STRING,
        "RequiredDate": _STRING,
        "ShippedDate": _STRING,
        "Status": _STRING,
        "Lines": ArrayType(_table({"ProductName": _STRING, "Price": _DOUBLE, "Quantity": _INT})),
        "TotalAmount": _DOUBLE,
        "ShipTo": _table({"City": _STRING, "Country": _STRING}),
        "Notes": _STRING,
    }
)

# Flat orders as landed.
LANDING = _table(
    {
        "OrderId": _STRING,
        "CustomerId": _STRING,
        "OrderDate": _TIME,
        "TotalAmount": _DOUBLE,
        "Status": _STRING,
        "ShipCity": _STRING,
        "ShipCountry": _STRING,
        "LineCount": _LONG,
        "SyncedAt": _TIME,
    }
)

# Managed orders; the line count is narrowed.
ORDERS = StructType(
    [StructField(f.name, _INT if f.name == "LineCount" else f.dataType) for f in LANDING]
)

# One metadata row per scientific file (30 columns).
FILE_METADATA = _table(
    {
        "file_path": _STRING,
        "file_name": _STRING,
        "file_size_bytes": _LONG,
        "file_modified_time": _STRING,
        "file_created_time": _STRING,
        "ingestion_time": _STRING,
        "tiled_uri": _STRING,
        "tiled_adapter": _STRING,
        "content_type": _STRING,
        "hdf5_driver": _STRING,
        "hdf5_libver": _STRING,
        "group_count": _INT,
        "dataset_count": _INT,
        "significant_datasets": _STRING,
        "entry_name": _STRING,
        "title": _STRING,
        "experiment_identifier": _STRING,
        "start_time": _STRING,
        "end_time": _STRING,
        "duration": _DOUBLE,
        "run_number": _STRING,
        "instrument_name": _STRING,
        "instrument_type": _STRING,
        "source_name": _STRING,
        "source_type": _STRING,
        "sample_name": _STRING,
        "sample_description": _STRING,
        "user_name": _STRING,
        "user_facility": _STRING,
        "extraction_error": _STRING,
    }
)

# The catalog types the ingest time and adds two columns.
H5_CATALOG = StructType(
    [StructField(f.name, _TIME if f.name == "ingestion_time" else f.dataType) for f in FILE_METADATA]
    + [StructField("s3_uri", _STRING), StructField("cataloged_at", _TIME)]
)

# File registry.
FILE_REGISTRY = _table(
    {
        "file_path": _STRING,
        "file_name": _STRING,
        "file_extension": _STRING,
        "size_bytes": _LONG,
        "ingested_at": _TIME,
    }
)

# Vector table.
VECTORS = _table({"id": _LONG, "order_id": _STRING, "vector": ArrayType(FloatType())})

#: One row per node of a hierarchical file, or per chunk of a large dataset.
#: Parallel datasets of one group use one chunk length, so their chunks meet on
#: (file_path, parent_path, chunk_offset). Exactly one of the three value
#: columns is non-null for a dataset. `depth` counts path components; the root
#: row (kind 'file', depth 0) carries the file's attributes.
H5_NODES = _table(
    {
        "file_path": _STRING,
        "node_path": _STRING,
        "parent_path": _STRING,
        "name": _STRING,
        "depth": _INT,
        "visit_order": _INT,
        "kind": _STRING,
        "attrs": MapType(_STRING, _STRING),
        "dtype": _STRING,
        "shape": ArrayType(_LONG),
        "size": _LONG,
        "chunk_offset": _LONG,
        "str_values": ArrayType(_STRING),
        "int_values": ArrayType(_LONG),
        "dbl_values": ArrayType(_DOUBLE),
    }
)
