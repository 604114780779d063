"""Compare registered queries with their SQL: python tests/oracle_check.py [sf] [name...]"""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple("\0null" if v is None else f"{type(v).__name__}:{v}" for v in row)


def _plain(value):
    return value.replace(tzinfo=None) if isinstance(value, datetime.datetime) else value


def compare(spark, con, sf_dir, name, build, sql) -> str:
    """Empty when equal, else what differs."""
    df = build(spark, sf_dir)
    columns = sorted(df.columns)
    rows = [tuple(map(_plain, r)) for r in df.select(*columns).collect()]
    if sql is None:
        return ""
    named = sorted(d[0] for d in con.execute(f"SELECT * FROM ({sql}) AS q LIMIT 0").description)
    if named != columns:
        return f"columns {columns} vs {named}"
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({sql}) AS q").fetchall()
    if len(rows) != len(expected):
        return f"rows {len(rows)} vs {len(expected)}"
    left, right = sorted(map(_key, rows)), sorted(map(_key, expected))
    for a, b in zip(left, right):
        if a != b:
            return f"{str(a)[:600]}\n   vs {str(b)[:600]}"
    return ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from webcorpus.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    spark = get_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(f"/root/testdata/{sf}")
    oracles = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, f"/root/testdata/{sf}", name, build, oracles.get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        mark = "ok" if not problem else "BAD"
        kind = "V" if name in oracles else "R"
        bad += bool(problem)
        print(f"{mark:4}{kind} {name:28}{time.time() - start:6.2f}s {problem}", flush=True)
    print("bad:", bad)
