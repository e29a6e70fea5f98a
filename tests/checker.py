"""Runs a registered query and its oracle SQL and compares columns, types and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


KINDS = {"boolean": "BOOLEAN", "int": "INTEGER", "long": "BIGINT", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def compare(df, con, sql):
    """List of differences, empty when equal."""
    relation = con.sql(sql)
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    theirs = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(set(ours) ^ set(theirs))}"]
    problems = [f"type {n}: {ours[n]} / {theirs[n]}" for n in ours if ours[n] != theirs[n]]
    names, left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    _, right = rows_of(relation.columns, relation.fetchall())
    if len(left) != len(right):
        problems.append(f"rows {len(left)} / {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        a, b = bad[0]
        diff = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
        problems.append(f"{len(bad)} rows differ, first: {diff}")
    if not left:
        problems.append("EMPTY")
    return problems
