"""Run a query in Spark and its SQL in DuckDB on the same tables and compare the rows."""

import math

import duckdb

TABLES = ["events", "orders", "lineitem"]


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(con, df, sql):
    """Empty when equal; otherwise a short description."""
    relation = con.sql(sql)
    left, right = sorted(df.columns), sorted(relation.columns)
    if left != right:
        return f"columns {left} != {right}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(relation.columns, relation.fetchall())
    if ours == theirs:
        return ""
    ours_only = sorted(set(ours) - set(theirs))[:3]
    theirs_only = sorted(set(theirs) - set(ours))[:3]
    return f"{len(ours)} rows against {len(theirs)}; only ours {ours_only}; only theirs {theirs_only}"
