"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return sorted((k, plain(v)) for k, v in value.items())
    return value


def rows(names: list[str], data) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


def differences(df, con, sql: str) -> list[str]:
    """Empty when column names and all rows agree exactly."""
    cur = con.execute(sql)
    theirs_names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    ours = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(theirs_names):
        return [f"columns {sorted(df.columns)} vs {sorted(theirs_names)}"]
    kinds = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}
    types = dict(zip(theirs_names, [str(d[1]) for d in cur.description]))
    odd = [
        f"type of {n}: {t} vs {types[n]}"
        for n, t in df.dtypes
        if types[n] in kinds and kinds[types[n]] != t or types[n] == "HUGEINT" or types[n].startswith("DECIMAL")
    ]
    a, b = rows(df.columns, ours), rows(theirs_names, theirs)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        odd.append(f"{len(a)} vs {len(b)} rows; ours {only_a}; theirs {only_b}")
    return odd
