"""Runs registered queries next to their SQL and compares rows.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark type name to DuckDB type name.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """None if the query and its SQL agree in names, types and rows."""
    result = entry.queries()[name](spark, sf_dir)
    wanted = connection.sql(entry.oracle_sql()[name])
    columns = sorted(result.columns)
    if columns != sorted(wanted.columns):
        return f"columns {columns} and {sorted(wanted.columns)}"
    types = {f.name: f.dataType.simpleString() for f in result.schema.fields}
    other = dict(zip(wanted.columns, map(str, wanted.types)))
    for c in columns:
        if TYPES.get(types[c]) != other[c]:
            return f"type of {c}: {types[c]} and {other[c]}"
    left = [tuple(r[c] for c in columns) for r in result.collect()]
    order = [wanted.columns.index(c) for c in columns]
    right = [tuple(r[i] for i in order) for r in wanted.fetchall()]
    if len(left) != len(right):
        return f"{len(left)} and {len(right)} rows"
    for a, b in zip(sorted(left, key=_key), sorted(right, key=_key)):
        same = all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        )
        if not same:
            return f"{a} and {b}"
    return None


def main() -> int:
    from wardline.session import build_session, release_scratch

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("compare", "local[8]", 8, {"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = difference(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{name:24s} {time.time() - start:6.2f}s {found or 'same'}", flush=True)
    release_scratch(spark)
    print(f"{len(names) - bad} of {len(names)} same")
    return bad


if __name__ == "__main__":
    sys.exit(main())
