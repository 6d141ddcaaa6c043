"""Runs a query and its SQL side by side and compares the rows."""

from __future__ import annotations

import math
from datetime import datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(canonical(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, query, sql, sf_dir) -> list[str]:
    """Differences found, none if both sides agree in names, types and values."""
    df = query(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    mine = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    problems = [f"{bad} in the plan" for bad in FORBIDDEN if bad in plan]
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema:
        kind = field.dataType.simpleString()
        if KINDS.get(kind, kind) != kinds[field.name]:
            problems.append(f"type of {field.name}: {kind} != {kinds[field.name]}")
    a, b = rows_of(df.columns, mine), rows_of(names, theirs)
    if len(a) != len(b):
        problems.append(f"{len(a)} rows != {len(b)} rows")
    if a != b:
        extra = [r for r in a if r not in b][:2] if len(a) < 3000 else "..."
        lacking = [r for r in b if r not in a][:2] if len(b) < 3000 else "..."
        pairs = [(x, y) for x, y in zip(a, b) if x != y][:1]
        problems.append(
            f"values differ ({sorted(names)}): only here {extra}, only there {lacking}, {pairs}"
        )
    return problems
