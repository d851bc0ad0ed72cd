"""Run queries in Spark and their SQL in DuckDB and compare the rows, ignoring order.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(df: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(df.columns)
    text = df[columns].copy()
    for name in columns:
        if pd.api.types.is_datetime64_any_dtype(text[name]):
            text[name] = text[name].astype("datetime64[us]").dt.strftime("%Y-%m-%d %H:%M:%S.%f")
        text[name] = text[name].map(_text)
    return text.sort_values(columns).reset_index(drop=True)


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and pd.isna(value)):
        return "<null>"
    if isinstance(value, float):
        return f"{value:.9g}"
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10] + " 00:00:00.000000" if not hasattr(value, "hour") else str(value)
    return str(value)


def difference(spark: SparkSession, sf_dir: str, name: str, connection) -> str | None:
    """``None`` when both sides agree, else a short description."""
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = connection.execute(ORACLE[name]).fetchdf()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    left, right = normal(ours), normal(theirs)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    if not left.equals(right):
        unequal = (left != right).any(axis=1)
        return f"{unequal.sum()} rows differ, e.g.\n{left[unequal].head(2).T}\n{right[unequal].head(2).T}"
    return None


def main() -> int:
    from ombuds.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "compare",
        "local[8]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    for name in names:
        started = time.time()
        if name in ORACLE:
            try:
                problem = difference(spark, sf_dir, name, connection)
            except Exception as error:  # noqa: BLE001
                problem = f"{type(error).__name__}: {str(error)[:600]}"
        else:
            problem = "no SQL"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
