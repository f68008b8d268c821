"""Compare each query with its SQL over the same tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SPARK_KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "\0null" if value is None else str(value)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types, row count and every value agree."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    rows = relation.fetchall()
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(set(names) ^ set(df.columns))}"]
    found = [
        f"type of {name}: {kind} against {kinds[name]}"
        for name, kind in df.dtypes
        if SPARK_KIND.get(kind, kind) != kinds[name]
    ]
    order = sorted(names)
    ours = sorted(tuple(_cell(r[n]) for n in order) for r in df.collect())
    position = [names.index(n) for n in order]
    theirs = sorted(tuple(_cell(r[i]) for i in position) for r in rows)
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    if ours != theirs:
        ours_only = sorted(set(ours) - set(theirs))[:2]
        theirs_only = sorted(set(theirs) - set(ours))[:2]
        found.append(f"{order}\n ours   {ours_only}\n theirs {theirs_only}")
    return found
