"""Compare registered queries with their SQL on the same tables.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
import pandas as pd

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    return None if value is None or pd.isna(value) else value


def _rows(frame) -> Counter:
    frame = frame[sorted(frame.columns)]
    return Counter(tuple(_plain(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def difference(spark, connection, sf_dir: str, name: str) -> str | None:
    """None when the query and its SQL agree, else what differs."""
    expected_sql = oracle_sql().get(name, "").replace("/root/testdata/sf0.01", sf_dir)
    found = queries()[name](spark, sf_dir).toPandas()
    if not expected_sql:
        return None if len(found) else "no rows"
    expected = connection.sql(expected_sql).df()
    if sorted(found.columns) != sorted(expected.columns):
        return f"columns {sorted(found.columns)} != {sorted(expected.columns)}"
    kinds = {
        c: (found[c].dtype.kind, expected[c].dtype.kind)
        for c in found.columns
        if found[c].dtype.kind != expected[c].dtype.kind and not found[c].isna().any()
    }
    if kinds:
        return f"types {kinds}"
    ours, theirs = _rows(found), _rows(expected)
    if ours != theirs:
        extra, missing = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return f"{len(found)} rows against {len(expected)}; only here {extra}; only there {missing}"
    return None if len(found) else "no rows"


def main(sf_dir: str, names: list[str]) -> int:
    from tablework.runtime import session

    spark = session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names or sorted(queries()):
        start = time.time()
        try:
            problem = difference(spark, connection, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(names or queries())} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
