"""Compare a Spark result with SQL over the same fixture files, value by value."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, Decimal)):
        return "float"
    return type(value).__name__


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, Decimal):
        return float(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kinds = {}
    out = Counter()
    for row in rows:
        for i in order:
            if row[i] is not None:
                kinds.setdefault(columns[i], _kind(row[i]))
        out[tuple(_norm(row[i]) for i in order)] += 1
    return [columns[i] for i in order], kinds, out


def differences(spark_df, sql: str, sf_dir: str) -> list[str]:
    con = connect(sf_dir)
    cursor = con.execute(sql)
    want_cols, want_kinds, want = _rows([c[0] for c in cursor.description], cursor.fetchall())
    got_cols, got_kinds, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    problems = []
    if want_cols != got_cols:
        problems.append(f"columns {got_cols} != {want_cols}")
        return problems
    if want_kinds != got_kinds:
        bad = {c: (got_kinds.get(c), want_kinds.get(c)) for c in want_cols if got_kinds.get(c) != want_kinds.get(c)}
        problems.append(f"types {bad}")
    if sum(want.values()) != sum(got.values()):
        problems.append(f"rows {sum(got.values())} != {sum(want.values())}")
    extra, missing = got - want, want - got
    if extra or missing:
        problems.append(f"{sum(extra.values())} extra, {sum(missing.values())} missing")
        for label, side in (("got", extra), ("want", missing)):
            for row in sorted(side, key=repr)[:2]:
                problems.append(f"  {label}: {dict(zip(want_cols, row))}")
    return problems
