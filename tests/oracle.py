"""Compares a query with its SQL as sets of rows, columns by name."""

import datetime
import decimal
import glob
import math
from collections import Counter
from pathlib import Path

import duckdb


def connection(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"create view {Path(f).stem} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(repr(plain(r[i])) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    found = con.sql(sql)
    return rows_of(found.columns, found.fetchall())
