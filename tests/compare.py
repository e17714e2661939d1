"""Run one query and its SQL twin and compare rows, ignoring their order."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def normal(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else (0.0 if v == 0 else v)
        return v

    shaped = [tuple(value(r[i]) for i in order) for r in rows]
    return sorted(shaped, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))


def differences(df, sql: str, sf_dir: str) -> list[str]:
    names, expected = oracle_rows(sql, sf_dir)
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    want = normal(names, expected)
    if len(got) != len(want):
        return [f"{len(got)} rows != {len(want)}", f"first {got[:2]} / {want[:2]}"]
    return [f"{g} != {w}" for g, w in zip(got, want) if g != w]
