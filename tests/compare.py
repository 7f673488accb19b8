"""Run a query and its SQL side by side and compare every row."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

#: Spark type -> DuckDB type that a result column must have.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "array<int>": "INTEGER[]",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(map(_plain, value))
    return value


def _sort_key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def rows_of(rows, names, order):
    at = [names.index(x) for x in order]
    return sorted((tuple(_plain(row[i]) for i in at) for row in rows), key=_sort_key)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types and all values agree."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = dict(df.dtypes)
    if set(ours) != set(theirs):
        return [f"columns {sorted(ours)} / {sorted(theirs)}"]
    bad = [f"type of {n}: {t} / {theirs[n]}" for n, t in ours.items() if TYPES.get(t) != theirs[n]]
    order = sorted(ours)
    a = rows_of(df.collect(), df.columns, order)
    b = rows_of(result.fetchall(), [d[0] for d in result.description], order)
    if len(a) != len(b):
        return [*bad, f"rows {len(a)} / {len(b)}"]
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    exact = len(wrong)
    wrong = [(x, y) for x, y in wrong if not all(_close(p, q) for p, q in zip(x, y))]
    if wrong:
        bad.append(f"{len(wrong)} of {len(a)} rows differ, columns {order}, first {wrong[0]}")
    elif exact:
        bad.append(f"{exact} of {len(a)} rows differ in the last digits, first "
                   f"{next((x, y) for x, y in zip(a, b) if x != y)}")
    return bad


def _close(x, y) -> bool:
    if isinstance(x, float) and isinstance(y, float):
        return math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12)
    return x == y
