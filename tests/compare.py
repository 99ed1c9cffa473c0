"""Run a registered query on Spark and its SQL on DuckDB and compare rows as multisets."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else float(f"{v:.9g}"))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def kind(v) -> str:
    return "num" if isinstance(v, (int, float)) and not isinstance(v, bool) else type(v).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, build, sql, sf_dir):
    """(problem or None, row count)"""
    df = build(spark, sf_dir)
    s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    d_cols, d_rows = rows_of([c[0] for c in cur.description], cur.fetchall())
    n = sum(s_rows.values())
    if s_cols != d_cols:
        return f"columns {s_cols} vs {d_cols}", n
    if s_rows != d_rows:
        return (
            f"rows {n} vs {sum(d_rows.values())}; spark only {list((s_rows - d_rows).items())[:2]}; "
            f"duckdb only {list((d_rows - s_rows).items())[:2]}",
            n,
        )
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    duck_types = dict((c[0], str(c[1])) for c in cur.description)
    wrong = {
        c: (spark_types[c], duck_types[c])
        for c in s_cols
        if ("double" == spark_types[c]) != (duck_types[c] in ("DOUBLE", "FLOAT", "NUMBER"))
        or ("HUGEINT" in duck_types[c])
        or ("DECIMAL" in duck_types[c])
    }
    return (f"types {wrong}" if wrong else None), n
