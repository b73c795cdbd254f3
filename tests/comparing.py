"""Run a named query in Spark and its SQL in DuckDB and compare whole results."""

import math
import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir=SF):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dict):
        return tuple(sorted((k, cell(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, check, sf_dir=SF):
    df = check.run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(check.sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    seen_got, seen_want = set(got), set(want)
    extra, missing = [r for r in got if r not in seen_want][:3], [r for r in want if r not in seen_got][:3]
    assert len(got) == len(want), (len(got), len(want), extra, missing)
    assert got == want, (extra, missing)
    return len(got)
