"""Compares registered queries with their SQL on the same tables.

``python tests/oracle.py [folder] [name …]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    base = duckdb.connect()
    for name in TABLES:
        base.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return base


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, base, name, function, sql, folder) -> str:
    """Empty when equal, otherwise what differs."""
    started = time.time()
    result = function(spark, folder)
    got = _rows(result.columns, result.collect())
    spent = time.time() - started
    if sql is None:
        return f"ok {len(got)} rows, no SQL, {spent:.1f} s"
    started = time.time()
    relation = base.sql(sql)
    want = _rows(relation.columns, relation.fetchall())
    other = time.time() - started
    if sorted(result.columns) != sorted(relation.columns):
        return f"DIFFERENT columns {result.columns} {relation.columns}"
    if got != want:
        extra, missing = list((got - want).items()), list((want - got).items())
        return (
            f"DIFFERENT {sum(got.values())} {sum(want.values())} extra {len(extra)} "
            f"{str(extra[:2])[:600]} missing {len(missing)} {str(missing[:2])[:600]}"
        )
    types = dict(zip(relation.columns, map(str, relation.types)))
    return f"ok {sum(got.values())} rows, {spent:.1f} s, SQL {other:.1f} s, {dict(result.dtypes)} {types}"


if __name__ == "__main__":
    from gristmill.queries import ALL
    from gristmill.session import build_session

    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    connection = database(where)
    bad = 0
    for key, (query, text) in ALL.items():
        if sys.argv[2:] and not any(key.startswith(p) for p in sys.argv[2:]):
            continue
        try:
            outcome = compare(session, connection, key, query, text, where)
        except Exception as error:
            outcome = "FAILED " + str(error)[:1200]
        bad += not outcome.startswith("ok")
        print(key, outcome, flush=True)
    print("bad:", bad)
