"""Rows of a Spark query and of DuckDB SQL in a comparable form."""

import glob
import os

import duckdb


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return str(v)


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(sql, sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows(names, result.fetchall())
