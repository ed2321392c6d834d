"""Rows of Spark and DuckDB in one form."""

import datetime as dt

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(float(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)[:10]
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


def of_spark(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def of_sql(con, sql):
    cursor = con.execute(sql)
    return rows([d[0] for d in cursor.description], cursor.fetchall())
