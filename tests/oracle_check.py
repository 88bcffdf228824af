"""Compare Spark results with their SQL twins: rows, column names, values."""

from __future__ import annotations

import glob
import math
from pathlib import Path

import duckdb

SQL_TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.sql(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Values are compared exactly, in any row order."""
    relation = connection.sql(sql)
    columns = sorted(relation.columns)
    if columns != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {columns}"
    kinds = dict(zip(relation.columns, map(str, relation.types), strict=True))
    other_kinds = {c: (t, kinds[c]) for c, t in df.dtypes if SQL_TYPES.get(t) != kinds[c]}
    if other_kinds:
        return f"types {other_kinds}"
    ours = sorted(map(_text, df.select(*columns).collect()))
    order = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(map(_text, relation.project(order).fetchall()))
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for mine, other in zip(ours, theirs, strict=True):
        if mine != other:
            return f"{mine} against {other}"
    return None


def _text(row) -> str:
    return repr([_plain(value) for value in row])


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value
