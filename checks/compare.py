"""Compare every query with its SQL twin: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = frame.astype(object).itertuples(index=False)
    return sorted((tuple(None if pd.isna(v) else str(v) for v in row) for row in rows), key=repr)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf: str, name: str) -> str | None:
    """None if both sides agree, else what differs."""
    spark_table = QUERIES[name](spark, sf).toArrow()
    sql_table = con.sql(ORACLES[name]).to_arrow_table()
    kinds = [
        {f.name: str(f.type).replace("large_", "") for f in t.schema} for t in (spark_table, sql_table)
    ]
    if kinds[0] != kinds[1]:
        return f"schema {kinds[0]} vs {kinds[1]}"
    left, right = _canonical(spark_table.to_pandas()), _canonical(sql_table.to_pandas())
    if not left:
        return "no rows"
    if len(left) != len(right):
        return f"{len(left)} vs {len(right)} rows"
    if left != right:
        return str(next((a, b) for a, b in zip(left, right, strict=True) if a != b))
    return None


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{Path(sf) / t}.parquet'")
    return con


def main(sf: str, *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name in names or QUERIES:
        started = time.monotonic()
        try:
            problem = compare(spark, con, sf, name)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{time.monotonic() - started:6.1f}s {name}: {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
