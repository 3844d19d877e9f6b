"""Results of a registered query and of its SQL in DuckDB, in one comparable form."""

import datetime
import decimal
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else float(f"{float(v):.9g}")
    if isinstance(v, int):
        return v
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return str(v)


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)


def rows_of_sql(sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    names = sorted(columns)
    return names, sorted((tuple(plain(r[columns.index(c)]) for c in names) for r in found.fetchall()), key=repr)
