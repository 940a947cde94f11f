"""Run registered queries against DuckDB: python -m tests.oracle_check [sf_dir] [name ...]."""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb
import pandas as pd

import __spark_entry__ as entry
from ledgerweb.functions.lineage import clear_scratch
from ledgerweb.plans.queries import TABLES
from ledgerweb.session import build_session


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NA or v is pd.NaT:
            return None
        return v.item() if hasattr(v, "item") else v

    rows = [tuple(cell(v) for v in row) for row in df.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in r))


def difference(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} != {sorted(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for col in left.columns:
        # Spark's pandas frames hold integers with nulls as floats.
        if str(right[col].dtype) == "Int64" and left[col].isna().any() and (left[col].dropna() % 1 == 0).all():
            left = left.assign(**{col: left[col].astype("Int64")})
        if str(left[col].dtype) != str(right[col].dtype):
            return f"type of {col}: {left[col].dtype} != {right[col].dtype}"
    a, b = canonical(left), canonical(right)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(entry.queries())
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-")})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            got = entry.queries()[name](spark, sf_dir).toPandas()
        except Exception as error:  # report and go on with the next query
            failed += 1
            print(f"ERROR {name}: {str(error)[:600]}", flush=True)
            continue
        took = time.time() - start
        sql = entry.oracle_sql().get(name)
        if sql is None:
            print(f"rows  {name}: {len(got)} rows, {took:.1f}s", flush=True)
            continue
        start = time.time()
        try:
            problem = difference(got, con.execute(sql).df())
        except Exception as error:
            problem = f"oracle: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok   ' if problem is None else 'FAIL '} {name}: {len(got)} rows, {took:.1f}s, sql {time.time() - start:.1f}s"
              + (f" | {problem}" if problem else ""), flush=True)
    clear_scratch(spark)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
