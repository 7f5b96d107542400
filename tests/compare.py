"""Spark result against DuckDB result, value by value, whatever the row order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return round(value, 9) if value != int(value) else int(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, run, sql: str, con, sf_dir: str) -> str | None:
    """None when equal, else a short description."""
    df = run(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if mine != theirs:
        only_mine, only_theirs = mine - theirs, theirs - mine
        return (
            f"rows {sum(mine.values())} vs {sum(theirs.values())}; "
            f"only here {list(only_mine)[:2]}; only SQL {list(only_theirs)[:2]}"
        )
    return None if mine else "empty result"
