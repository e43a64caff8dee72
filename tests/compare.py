"""Run a query in Spark and its SQL in DuckDB and compare every value."""

from __future__ import annotations

import glob
import os

import duckdb

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _sorted(rows, order):
    picked = [tuple(r[i] for i in order) for r in rows]
    return sorted(picked, key=lambda r: [(x is None, str(type(x)), x if x is not None else 0) for x in r])


def differences(df, con, sql: str) -> str:
    relation = con.sql(sql)
    ours, theirs = list(df.columns), list(relation.columns)
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    names = sorted(ours)
    kinds = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    wanted = dict(zip(theirs, map(str, relation.types)))
    wrong = {n: (kinds[n], wanted[n]) for n in names if kinds[n] != wanted[n]}
    if wrong:
        return f"types {wrong}"
    left = _sorted([tuple(r) for r in df.collect()], [ours.index(n) for n in names])
    right = _sorted(relation.fetchall(), [theirs.index(n) for n in names])
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    apart = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(apart)} of {len(left)} rows differ, e.g. {names}: {apart[0]}" if apart else ""
