"""Runs registered queries next to their SQL in DuckDB and compares the rows.

    python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        value = float(value)
        return (0, "") if math.isnan(value) else (2, f"{value:.9g}" if abs(value) > 1e-12 else "0")
    if isinstance(value, datetime.datetime):
        value = value.date()
    return (3, str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def difference(spark, db, build, sql: str, folder: str) -> str | None:
    """None when equal, else a short description."""
    df = build(spark, folder)
    ours = df.collect()
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, e.g. {wrong[0]}" if wrong else None


def main() -> int:
    from pyspark.sql import SparkSession

    from checks import catalog
    from crivo.session import tuned

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalog.QUERIES)
    spark = tuned(
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for name in names:
        began = time.time()
        try:
            if name in catalog.ORACLES:
                found = difference(spark, db, catalog.QUERIES[name], catalog.ORACLES[name], folder)
            else:
                found = None if catalog.QUERIES[name](spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'BAD '} {name:24} {time.time() - began:6.2f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
