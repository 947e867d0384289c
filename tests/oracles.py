"""Compare a registered query with its SQL in DuckDB, as rows in any order."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def assert_same(spark, sf_dir: str, query, sql: str) -> None:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    found = con.execute(sql)
    order = [d[0] for d in found.description]
    assert sorted(order) == names
    places = [order.index(n) for n in names]
    text = lambda rows: sorted(repr(tuple(plain(v) for v in r)) for r in rows)
    assert text([r[n] for n in names] for r in df.collect()) == text([r[p] for p in places] for r in found.fetchall())
