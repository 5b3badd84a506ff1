"""Expressions over file paths, keys and locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions of scientific files.
SCIENCE_EXTENSIONS = ("h5", "hdf5", "nxs", "nx5")
# The narrower set used when a bucket is listed for serving.
BUCKET_EXTENSIONS = ("h5", "hdf5", "nxs")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def file_name(path: Column | str) -> Column:
    """Last component of a path ('' for a path that ends in a slash)."""
    return F.regexp_extract(_col(path), r"[^/]+$", 0)


def file_extension(path: Column | str) -> Column:
    """Text after the last dot of the file name, NULL when there is none."""
    return F.nullif(F.regexp_extract(file_name(path), r"\.([^.]+)$", 1), F.lit(""))


def has_science_extension(
    path: Column | str, extensions: tuple[str, ...] = SCIENCE_EXTENSIONS
) -> Column:
    """Case-insensitive extension test; a bare dot file has no extension."""
    return _col(path).rlike(r"(?i)[^/]\.(" + "|".join(extensions) + ")$")


def stem(name: Column | str) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(_col(name), r"^(.+)\.[^.]*$", "$1")


def safe_key(name: Column | str) -> Column:
    """Dots and dashes become underscores."""
    return F.translate(_col(name), ".-", "__")


def output_base_name(path: Column | str) -> Column:
    """Stem with any remaining '.nxs' and '.h5' removed."""
    bare = F.replace(stem(file_name(path)), F.lit(".nxs"), F.lit(""))
    return F.replace(bare, F.lit(".h5"), F.lit(""))


def location_uri(location: Column | str, fallback: Column | str | None = None) -> Column:
    """`file://` for plain paths; existing file and s3 locations are kept."""
    where = _col(location)
    if fallback is not None:
        where = F.coalesce(F.nullif(where, F.lit("")), _col(fallback))
    return F.when(where.rlike(r"^(file|s3)://"), where).otherwise(F.concat(F.lit("file://"), where))


def uploaded_uri(prefix: str, name: Column | str) -> Column:
    """Location of a file after upload below ``prefix``."""
    return F.concat(F.lit(prefix.rstrip("/") + "/"), _col(name))
