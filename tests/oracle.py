"""Runs a query's SQL in DuckDB and compares it with the query's rows, columns by name."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql_rows(sql: str, sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    found = connection.sql(sql)
    columns = list(found.columns)
    return sorted(columns), [tuple(row[columns.index(c)] for c in sorted(columns)) for row in found.fetchall()]


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b


def assert_matches(df, sql: str, sf_dir: str) -> None:
    columns, wanted = sql_rows(sql, sf_dir)
    assert sorted(df.columns) == columns
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    assert len(got) == len(wanted)
    for a, b in zip(sorted(got, key=repr), sorted(wanted, key=repr), strict=True):
        assert all(map(same, a, b)), (a, b)
