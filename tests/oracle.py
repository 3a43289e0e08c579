"""Runs a registered query and its SQL on the same tables and compares all rows exactly."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS FROM read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def kind(value) -> str:
    return type(value).__name__


def compare(frame, db, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    names = sorted(frame.columns)
    got = [tuple(plain(r[n]) for n in names) for r in frame.collect()]
    result = db.execute(sql)
    theirs = [d[0] for d in result.description]
    if sorted(theirs) != names:
        return f"columns {names} != {sorted(theirs)}"
    order = [theirs.index(n) for n in names]
    want = [tuple(plain(r[i]) for i in order) for r in result.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for i, name in enumerate(names):
        mine = {kind(r[i]) for r in got} - {"NoneType"}
        other = {kind(r[i]) for r in want} - {"NoneType"}
        if mine != other:
            return f"{name}: types {mine} != {other}"
    left, right = Counter(got), Counter(want)
    if left != right:
        return f"{names}: only here {list((left - right).items())[:3]}, only there {list((right - left).items())[:3]}"
    return None
