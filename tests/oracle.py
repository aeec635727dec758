"""Compares a query with its SQL in DuckDB over the same parquet tables."""

import glob
import os

import duckdb
import pandas as pd

DATA = "/root/testdata"


def connect(sf: str = "sf0.001"):
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(plain(v) for v in r) for r in df.itertuples(index=False, name=None))


def same(spark, query, sql: str, sf: str = "sf0.001") -> None:
    got = query(spark, f"{DATA}/{sf}").toPandas()
    want = connect(sf).execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
