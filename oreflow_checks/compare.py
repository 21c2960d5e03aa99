"""Run registered queries against their SQL counterparts: ``python -m oreflow_checks.compare [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from oreflow_checks.oracle import ORACLE
from oreflow_checks.queries import QUERIES
from oreflow.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_normal(row[i]) for i in order) for row in rows), key=repr)


def difference(spark: SparkSession, connection, name: str, sf_dir: str) -> str | None:
    """None when both engines return the same columns and rows, else what differs first."""
    frame = QUERIES[name](spark, sf_dir)
    result = connection.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} / {sorted(columns)}"
    mine, theirs = _rows(frame.collect(), frame.columns), _rows(result.fetchall(), columns)
    if mine == theirs:
        return None if mine else "both empty"
    first = next(((a, b) for a, b in zip(mine, theirs) if a != b), None)
    return f"{len(mine)} / {len(theirs)} rows; first difference: {first}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("oreflow-checks", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = oracle_connection(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            found = difference(spark, connection, name, sf_dir) if name in ORACLE else "no oracle"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
