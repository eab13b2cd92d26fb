"""Run a registered query and its SQL counterpart and compare the whole results."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(path: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, Decimal):
        return "dec:" + str(v)
    return f"{type(v).__name__}:{v}"


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(cell(r[i]) for i in order) for r in rows)


TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}


def check(spark, con, path, build, sql):
    """Empty list, or what differs."""
    df = build(spark, path)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    problems = []
    for name, kind in df.dtypes:
        if name in types and TYPE_NAMES.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} / {types[name]}")
    names, got = normal(df.columns, [tuple(r) for r in df.collect()])
    names2, want = normal(columns, result.fetchall())
    if names != names2:
        problems.append(f"columns {names} / {names2}")
    elif got != want:
        problems.append(f"rows {len(got)} / {len(want)}")
        extra = sorted(set(got) - set(want))[:3]
        missing = sorted(set(want) - set(got))[:3]
        problems.append(f"only here {extra}; only in SQL {missing}")
    return problems, len(got)
