"""Results of queries against DuckDB over the same files."""

import datetime
import decimal
from pathlib import Path

import duckdb
import pandas as pd

SMALL = "/root/testdata/sf0.001"


def plain(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return None
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, decimal.Decimal):
        x = int(x) if x == int(x) else float(x)
    return str(x) if isinstance(x, (datetime.datetime, pd.Timestamp)) else x


def rows(df: pd.DataFrame, columns: list[str]) -> list[str]:
    return sorted(repr(tuple(plain(x) for x in r)) for r in df[columns].astype(object).itertuples(index=False))


def oracle(sql: str, sf_dir: str = SMALL) -> pd.DataFrame:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con.execute(sql).df()


def assert_same(spark, run, sql: str, sf_dir: str = SMALL) -> None:
    got, want = run(spark, sf_dir).toPandas(), oracle(sql, sf_dir)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)
