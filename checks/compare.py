"""Runs registered queries next to their SQL and reports differences: python -m checks.compare [folder] [name-part ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from checks import oracles, registry
from storeglass.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(root: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def compare(spark, con, name: str, root: str, sql: str | None):
    """(number of rows, problem or None)"""
    frame = registry.queries()[name](spark, root)
    columns = sorted(frame.columns)
    mine = sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)
    if sql is None:
        return len(mine), None
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return len(mine), f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=repr)
    if len(mine) != len(theirs):
        return len(mine), f"{len(mine)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return len(mine), f"{len(wrong)} rows differ on {columns}, first {wrong[0]}" if wrong else None


def main() -> int:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    parts = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(root), oracles.oracle_sql(), 0
    for name in registry.queries():
        if parts and not any(p in name for p in parts):
            continue
        begun = time.time()
        try:
            rows, problem = compare(spark, con, name, root, sql.get(name))
        except Exception as error:  # a report of all queries is wanted, not the first failure
            rows, problem = -1, f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - begun:6.2f}s {rows:7d} {name} {problem or ''}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
