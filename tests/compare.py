"""Order-insensitive comparison of a query with its SQL oracle."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _normal(value):
    return None if value is None or value != value else value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_normal(r[i]) for i in order) for r in rows), key=repr)


def expected(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _sorted_rows(columns, cursor.fetchall())


def actual(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def difference(df, con, sql: str) -> str | None:
    got_columns, got = actual(df)
    want_columns, want = expected(con, sql)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got == want:
        return None
    types = [(c, [type(v).__name__ for v in pair]) for c, *pair in zip(got_columns, got[0], want[0], strict=True)] if got and want else []
    got_set, want_set = set(got), set(want)
    only_got = [r for r in got if r not in want_set][:2]
    only_want = [r for r in want if r not in got_set][:2]
    return f"{len(got)} vs {len(want)} rows; only got {only_got}; only expected {only_want}; {got_columns}; {types}"
