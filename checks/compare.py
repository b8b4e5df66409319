"""Run the registered queries next to their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.spark_queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return db


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, db, sf: str, name: str) -> tuple[str, int, str]:
    """``(verdict, rows, detail)`` of one query."""
    df = QUERIES[name](spark, sf)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        return ("rows only" if found else "EMPTY"), len(found), ""
    cursor = db.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    wanted = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return "COLUMNS", len(found), f"{sorted(df.columns)} / {sorted(columns)}"
    if found == wanted:
        return "equal", len(found), ""
    if len(found) != len(wanted):
        detail = f"{len(found)} / {len(wanted)} rows"
    else:
        differing = [(a, b) for a, b in zip(found, wanted) if a != b]
        detail = f"{len(differing)} differ, e.g. {str(differing[0])[:400]}"
    return "DIFFERENT", len(found), detail


def main() -> None:
    from skeindex.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            verdict, count, detail = compare(spark, db, sf, name)
        except Exception as error:
            verdict, count, detail = "ERROR", 0, f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict not in ("equal", "rows only")
        print(f"{name:22} {verdict:10} {count:8} {time.time() - start:6.1f}s {detail}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
