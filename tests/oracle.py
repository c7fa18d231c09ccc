"""Compares registered queries with their SQL counterpart on an in-process engine."""

from __future__ import annotations

import datetime
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def _close(a, b) -> bool:
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return math.isclose(a, b, rel_tol=1e-7, abs_tol=2e-6)
    return a == b


def compare(spark, con, sf_dir, name, fn, sql) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    t1 = time.time()
    out = {"name": name, "rows": len(got), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        return out | {"status": "rows-only"}
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    out["sql_s"] = round(time.time() - t1, 2)
    if sorted(df.columns) != sorted(names):
        return out | {"status": f"COLUMNS {sorted(df.columns)} vs {sorted(names)}"}
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        return out | {"status": f"ROWS {len(a)} vs {len(b)}"}
    if not a:
        return out | {"status": "EMPTY"}
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if not bad:
        types = {type(x) for x, y in zip(a[0], b[0])} ^ {type(y) for x, y in zip(a[0], b[0])}
        return out | {"status": "match" if not types else f"match, types {types}"}
    if all(all(_close(p, q) for p, q in zip(x, y)) for x, y in bad):
        return out | {"status": f"CLOSE {len(bad)} of {len(a)}: {bad[0]}"}
    return out | {"status": f"DIFF {len(bad)} of {len(a)}: {sorted(names)} {bad[0]}"}
