"""Run a query and its SQL twin on the sample tables and compare every value."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _ordered(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in places) for r in rows), key=repr)


def differences(spark, con, sf_dir, query, sql) -> list[str]:
    df = query(spark, sf_dir)
    got = _ordered(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _ordered(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    out = [] if len(got) == len(want) else [f"{len(got)} rows != {len(want)}"]
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            out.append(f"{a} != {b}")
    return out
