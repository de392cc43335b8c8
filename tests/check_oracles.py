"""Run registered queries against their SQL: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from weir.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted by a type-aware text form."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda row: tuple(map(repr, row))
    )


def compare(spark, db, sf_dir: str, name: str) -> list[str]:
    """Differences between a query and its SQL: names, types, rows and values."""
    df = entry.queries()[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(row) for row in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return [] if got else ["no rows"]
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    want = canonical(columns, result.fetchall())
    problems = []
    if sorted(columns) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    if not want:
        problems.append("the SQL gives no rows, so the check is empty")
    different = [(a, b) for a, b in zip(got, want) if repr(a) != repr(b)]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0]}")
    return problems


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(
        "oracles",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failed = 0
    for name in args or entry.queries():
        start = time.time()
        try:
            problems = compare(spark, db, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", *problems, sep="\n     " if problems else " ")
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
