"""Run a registered query in Spark and its SQL in DuckDB and compare the results."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None
                                                          else 0) for v in r))


def spark_rows(df):
    return as_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return as_rows([d[0] for d in cur.description], cur.fetchall())


def difference(a, b):
    """None when equal (values exactly, as a value hash would see them)."""
    (names_a, rows_a), (names_b, rows_b) = a, b
    if names_a != names_b:
        return f"columns {names_a} vs {names_b}"
    if len(rows_a) != len(rows_b):
        return f"{len(rows_a)} rows vs {len(rows_b)}"
    bad = [(x, y) for x, y in zip(rows_a, rows_b) if x != y or
           [type(v) for v in x] != [type(v) for v in y]]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
