"""Run a registered query and its SQL on the same folder and compare them."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal_type(kind: pa.DataType) -> str:
    if pa.types.is_timestamp(kind):
        return "timestamp"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    return str(kind)


def compare(spark_table: pa.Table, oracle_table: pa.Table) -> str | None:
    """None when equal as multisets of typed rows, else what differs."""
    left = {f.name: normal_type(f.type) for f in spark_table.schema}
    right = {f.name: normal_type(f.type) for f in oracle_table.schema}
    if left != right:
        return f"schema: {sorted(set(left.items()) ^ set(right.items()))}"
    if spark_table.num_rows != oracle_table.num_rows:
        return f"rows: {spark_table.num_rows} against {oracle_table.num_rows}"
    names = sorted(left)
    ours = sorted(map(repr, zip(*[spark_table.column(n).to_pylist() for n in names])))
    theirs = sorted(map(repr, zip(*[oracle_table.column(n).to_pylist() for n in names])))
    for a, b in zip(ours, theirs):
        if a != b:
            return f"values {names}:\n  {a}\n  {b}"
    return None
