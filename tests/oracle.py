"""Compare a registered query with its oracle SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = pathlib.Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(value) -> str:
    return "date" if type(value) is dt.date else type(value).__name__


def norm(value):
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimals do not compare across engines; cast them")
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple], dict[str, set[str]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    kinds = {n: {kind(r[i]) for r in out if r[i] is not None} for i, n in enumerate(names)}
    return names, sorted(out, key=lambda r: [(v is None, str(v)) for v in r]), kinds


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, value types, row count and all values agree."""
    spark_columns, spark_rows, spark_kinds = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.cursor()
    cursor.execute(sql)
    columns, rows, kinds = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if spark_columns != columns:
        return [f"columns {spark_columns} != {columns}"]
    found = []
    if len(spark_rows) != len(rows):
        found.append(f"rows {len(spark_rows)} != {len(rows)}")
    if spark_kinds != kinds:
        found.append(f"types {[(c, spark_kinds[c], kinds[c]) for c in columns if spark_kinds[c] != kinds[c]]}")
    wrong = [(a, b) for a, b in zip(spark_rows, rows) if a != b]
    found += [f"{a} != {b}" for a, b in wrong[:3]]
    return found
