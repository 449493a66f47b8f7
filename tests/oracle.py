"""A query's rows from Spark and from DuckDB, in one comparable form."""

import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    same = {"None": "nan", "<NA>": "nan", "NaT": "nan", "-0.0": "0.0"}
    return columns, sorted(map(tuple, frame[columns].astype(str).replace(same).to_numpy().tolist()))
