"""Spark against DuckDB: the same rows, whatever their order."""

import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{files}'")
    return con


def plain(value):
    if value is None or value != value:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(round(float(value), 6))
    return str(value)


def rows(tuples):
    return sorted(tuple(plain(v) for v in t) for t in tuples)


def same(spark_df, con, sql):
    columns = sorted(spark_df.columns)
    relation = con.sql(sql)
    assert sorted(relation.columns) == columns
    names = ", ".join(f'"{c}"' for c in columns)
    expected = con.sql(f"SELECT {names} FROM ({sql})").fetchall()
    assert rows(map(tuple, spark_df.select(*[f"`{c}`" for c in columns]).collect())) == rows(expected)
