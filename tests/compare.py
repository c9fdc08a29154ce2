"""Run registered queries against their SQL in DuckDB: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from glob import glob

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, columns by name."""

    def text(value) -> str:
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return "NULL"
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        if hasattr(value, "item"):
            value = value.item()
        if isinstance(value, float):
            return repr(value + 0.0)
        return str(value)

    columns = sorted(df.columns)
    objects = df[columns].astype(object)
    return sorted(tuple(text(v) for v in row) for row in objects.itertuples(index=False))


def kinds(df: pd.DataFrame) -> dict[str, str]:
    """Coarse column types: NULLs make pandas widen integers, so numbers are one kind."""

    def kind(dtype) -> str:
        if pd.api.types.is_datetime64_any_dtype(dtype):
            return "time"
        return "number" if pd.api.types.is_numeric_dtype(dtype) else "text"

    return {c: kind(df[c].dtype) for c in sorted(df.columns)}


def differences(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """What differs between the two results, or None."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    ours, theirs = kinds(spark_df), kinds(sql_df)
    for name, kind in ours.items():
        filled = spark_df[name].notna().any() and sql_df[name].notna().any()
        if filled and kind != theirs[name]:
            return f"type of {name}: {kind} != {theirs[name]}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} != {len(sql_df)}"
    for i, name in enumerate(sorted(spark_df.columns)):
        if ours[name] == "number":  # integers widened on one side compare as numbers
            spark_df[name] = pd.to_numeric(spark_df[name]).astype(float)
            sql_df[name] = pd.to_numeric(sql_df[name]).astype(float)
    a, b = canonical(spark_df), canonical(sql_df)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ in {sorted(spark_df.columns)}, first {wrong[0]}"
    return None


def main() -> int:
    from fraudlens.plans import catalog
    from fraudlens.session import build_session

    arguments = sys.argv[1:]
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(catalog.QUERIES)
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            ours = catalog.QUERIES[name](spark, sf_dir).toPandas()
            seconds = time.time() - start
            if name in catalog.CHECKS:
                problem = differences(ours, con.execute(catalog.CHECKS[name]).df())
            else:
                problem = None if len(ours) else "no rows"
        except Exception as error:  # report and go on
            seconds, ours = time.time() - start, ()
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        kind = "sql " if name in catalog.CHECKS else "rows"
        state = "FAIL" if problem else "ok  "
        print(f"{state} {kind} {name:24s} {len(ours):7d} rows {seconds:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} ok")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
