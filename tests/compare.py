"""Compare a registered query with the SQL stating its result, by value and regardless of order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb



def _value(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        number = float(v)
        return None if math.isnan(number) else round(number, 6) + 0.0
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def expected(sql: str, sf_dir: str):
    with duckdb.connect() as con:
        for file in sorted(Path(sf_dir).glob("*.parquet")):
            con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
        result = con.execute(sql)
        return [d[0] for d in result.description], result.fetchall()


def differences(df, sql: str, sf_dir: str) -> str:
    """Empty when both agree."""
    names, rows = expected(sql, sf_dir)
    if sorted(df.columns) != sorted(names):
        return f"columns: only ours {set(df.columns) - set(names)}, only expected {set(names) - set(df.columns)}"
    ours, theirs = _bag(df.columns, df.collect()), _bag(names, rows)
    if ours == theirs:
        return ""
    return (
        f"rows {sum(ours.values())} vs {sum(theirs.values())} {sorted(names)}\n ours only: "
        f"{list((ours - theirs).items())[:3]}\n expected only: {list((theirs - ours).items())[:3]}"
    )
