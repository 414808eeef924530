"""Compare a registered query with its SQL restatement."""

import glob
import os

import duckdb

from chunkloom.plans.catalog import QUERIES
from chunkloom.plans.oracle import ORACLE


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(str(r[i]) for i in order) for r in rows)


def both(spark, con, sf_dir: str, key: str):
    df = QUERIES[key](spark, sf_dir)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLE[key])
    columns = [d[0] for d in cursor.description]
    return found, rows_of(columns, cursor.fetchall())
