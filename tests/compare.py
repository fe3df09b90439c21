"""Run a query and its SQL side by side: names, types, rows in any order."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations""".split()

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def database(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def ordered(rows, names):
    places = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[i]) for i in places) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both results are the same."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    types = {d[0]: str(d[1]) for d in found.description}
    expected = found.fetchall()
    actual = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != types[name]:
            problems.append(f"type of {name}: {kind} != {types[name]}")
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    a, b = ordered(actual, df.columns), ordered(expected, names)
    if a != b:
        other = [pair for pair in zip(a, b) if pair[0] != pair[1]]
        problems.append(f"{len(other)} rows differ, first {other[:2]}")
    return problems
