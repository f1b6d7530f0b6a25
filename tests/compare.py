"""Rows of a Spark query beside those of its oracle in DuckDB."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb


def plain(v):
    """A value as both engines give it: numbers without their type, nested values as tuples, no bytearrays."""
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        v = float(v) if v % 1 else int(v)
    if isinstance(v, float):
        return "nan" if v != v else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def family(name: str) -> str:
    """A type's family: integers and decimals are apart from floating point, as their hashes are."""
    name = name.lower()
    for kind, words in {
        "list": ("array", "[]"),
        "integer": ("int", "long", "short"),
        "float": ("double", "float"),
        "decimal": ("decimal",),
        "string": ("string", "varchar"),
        "boolean": ("bool",),
        "timestamp": ("timestamp",),
        "date": ("date",),
        "struct": ("struct",),
        "binary": ("binary", "blob"),
    }.items():
        if any(w in name for w in words):
            return kind
    return name


def oracle(sql: str, folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    return names, [family(str(d[1])) for d in got.description], got.fetchall()


def differences(df, sql: str, folder: str) -> str:
    """What differs between a DataFrame and the oracle's rows; empty if nothing does."""
    names, kinds, want = oracle(sql, folder)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    order = sorted(df.columns)
    own = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
    other = {n: k for n, k in zip(names, kinds)}
    if odd := {n: (own[n], other[n]) for n in order if own[n] != other[n]}:
        return f"types {odd}"
    key = lambda row: repr(row)
    a = sorted((tuple(plain(r[n]) for n in order) for r in df.collect()), key=key)
    at = [names.index(n) for n in order]
    b = sorted((tuple(plain(r[k]) for k in at) for r in want), key=key)
    if a == b:
        return ""
    return f"{len(a)} and {len(b)} rows; only in Spark {[x for x in a if x not in b][:3]}, only in the oracle {[x for x in b if x not in a][:3]}"
