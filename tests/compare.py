"""Order-insensitive comparison of a Spark query with its SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> str | None:
    found = connection.execute(sql)
    columns = [d[0] for d in found.description]
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in found.description}
    wrong = [(c, kind, kinds[c]) for c, kind in frame.dtypes if KINDS.get(kind) != kinds[c]]
    if wrong:
        return f"types {wrong}"
    ours = _bag(frame.columns, [tuple(r) for r in frame.collect()])
    theirs = _bag(columns, found.fetchall())
    if ours == theirs:
        return None
    return (
        f"{sum(ours.values())} vs {sum(theirs.values())} rows; ours only: "
        f"{list((ours - theirs).items())[:3]}; theirs only: {list((theirs - ours).items())[:3]}"
    )
