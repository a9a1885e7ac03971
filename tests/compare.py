"""Rows of Spark and DuckDB in one comparable form."""

import os

import duckdb
import numpy as np
import pandas as pd


def plain(df: pd.DataFrame) -> list[tuple]:
    out = []
    for row in df[sorted(df.columns)].itertuples(index=False):
        cells = []
        for x in row:
            if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float | np.floating) and np.isnan(x):
                cells.append("")
            elif isinstance(x, bool | np.bool_):
                cells.append(str(bool(x)))
            elif isinstance(x, int | float | np.integer | np.floating):
                cells.append(repr(round(float(x), 9)))
            else:
                cells.append(str(x).replace(" 00:00:00", ""))
        out.append(tuple(cells))
    return sorted(out)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con
