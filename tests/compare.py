"""Run a registered query and its SQL, and compare rows as multisets with their types."""

from __future__ import annotations

import datetime
import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("dec", str(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(row[n]) for n in names) for row in df.collect())


def duck_rows(con, sql: str):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows


def difference(df, con, sql: str) -> str | None:
    """None when both agree, else a short account of how they differ."""
    names, ours = spark_rows(df)
    theirs_names, theirs = duck_rows(con, sql)
    if names != theirs_names:
        return f"columns {names} != {theirs_names}"
    if ours != theirs:
        return (f"{sum(ours.values())} rows against {sum(theirs.values())}; only Spark: "
                f"{list((ours - theirs).items())[:2]}; only SQL: {list((theirs - ours).items())[:2]}")
    if not ours:
        return "no rows at all"
    return None
