"""Holds a registered query against its SQL on DuckDB, without regard to order."""

from __future__ import annotations

import os

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
THERE = os.path.isdir(SF)


def _plain(value):
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


def assert_matches(spark, query, sql: str) -> None:
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    df = query(spark, SF)
    assert sorted(df.columns) == sorted(names)
    expected = sorted(tuple(_plain(dict(zip(names, r))[c]) for c in df.columns) for r in found.fetchall())
    assert sorted(tuple(map(_plain, r)) for r in df.collect()) == expected
