"""Compare registered queries with their SQL in a second engine."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def value(item):
    if isinstance(item, (float, Decimal)):
        number = float(item)
        return None if math.isnan(number) else round(number, 9)
    if isinstance(item, dt.datetime):
        return item.replace(tzinfo=None).isoformat()
    return item


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(value(row[i]) for i in order) for row in data)


def differences(spark, con, query, oracle: str, folder: str) -> str | None:
    """None if both engines agree, else what differs."""
    df = query(spark, folder)
    cursor = con.execute(oracle)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    ours = rows(df.columns, df.collect())
    theirs = rows(names, cursor.fetchall())
    if ours == theirs:
        return None
    extra, absent = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    return f"{sum(ours.values())} and {sum(theirs.values())} rows; only ours {extra}; only theirs {absent}"
