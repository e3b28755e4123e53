"""Runs registered queries and their SQL twins on the same tables and compares them."""

from __future__ import annotations

import glob
import os

import duckdb

# Spark simple type -> DuckDB type.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when schema and rows agree, otherwise what differs."""
    rel = con.sql(sql)
    ours = dict(df.dtypes)
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    for name, kind in ours.items():
        got = "VARCHAR" if theirs[name] == "JSON" else theirs[name]
        if TYPES.get(kind, kind) != got:
            return f"type of {name}: {kind} != {theirs[name]}"
    names = sorted(ours)
    a = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    at = [rel.columns.index(n) for n in names]
    b = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"row {str(x)[:600]}\n != {str(y)[:600]}"
    return None
