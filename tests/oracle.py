"""Compare a registered query with its SQL check on the same parquet files."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sortable(row):
    return tuple((v is None, str(type(v)) if v is None else "", str(v)) for v in row)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=_sortable)


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_sortable)
    return [names[i] for i in order], rows


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql, limit=3):
    """Empty when columns, types and values are equal, else a short description."""
    declared = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    types = {c: SQL_TYPES.get(t, t) for c, t in df.dtypes}
    if types != declared:
        return f"types {sorted(set(types.items()) ^ set(declared.items()))}"
    columns, left = spark_rows(df)
    names, right = duck_rows(con, sql)
    if columns != names:
        return f"columns {columns} vs {names}"
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}; {left[:2]} {right[:2]}"
    bad = [(a, b) for a, b in zip(left, right) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(bad)} of {len(left)} rows differ: {bad[:limit]}" if bad else ""
