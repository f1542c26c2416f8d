"""Compare a registered query with its SQL counterpart: schema, count, values."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_KINDS = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return repr(0.0 if v == 0 else v)
    if isinstance(v, (decimal.Decimal, datetime.date)):
        return str(v)
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    got_names = df.columns
    got = _bag(got_names, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want_names, want_types = rel.columns, [str(t) for t in rel.types]
    want = _bag(want_names, rel.fetchall())
    out = []
    if sorted(got_names) != sorted(want_names):
        return [f"columns {sorted(got_names)} != {sorted(want_names)}"]
    got_types = {n: _KINDS.get(t, t) for n, t in df.dtypes}
    for n, t in zip(want_names, want_types, strict=True):
        if got_types[n] != t:
            out.append(f"type of {n}: {got_types[n]} != {t}")
    if sum(got.values()) != sum(want.values()):
        out.append(f"rows {sum(got.values())} != {sum(want.values())}")
    if got != want:
        out.append(f"only in Spark {list((got - want).items())[:3]}")
        out.append(f"only in SQL {list((want - got).items())[:3]}")
    return out
