"""Compares queries with their SQL as the driver does: columns by name, rows in any order, values."""

from __future__ import annotations

import math
import os
import sys

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(os.listdir(d)):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from read_parquet('{d}/{f}')")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__module__ == "numpy" and getattr(v, "ndim", 1) == 0 and v.dtype.kind in "iuf":
        return f"{round(float(v), 6) + 0.0:.6g}"
    if hasattr(v, "tolist") and not isinstance(v, pd.Timestamp):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_cell, v)) + "]"
    if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
        return v.isoformat().replace("T00:00:00", "")
    return str(v)


def table(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(map(_cell, r)) for r in pdf.astype(object).itertuples(index=False))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} <> {sorted(want.columns)}"
    a, b = table(got), table(want)
    if len(a) != len(b):
        return f"rows {len(a)} <> {len(b)}; only here {list(set(a) - set(b))[:2]}, only there {list(set(b) - set(a))[:2]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else ""
