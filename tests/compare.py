"""Run registered queries against their SQL twins.

``python -m tests.compare [sf] [name ...]``
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DATA = "/root/testdata"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cells(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))


def differences(spark_df, relation) -> str | None:
    """None when both results hold the same rows under the same column names."""
    cols = sorted(spark_df.columns)
    theirs = sorted(relation.columns)
    if cols != theirs:
        return f"columns {cols} != {theirs}"
    mine = _cells(spark_df.select(*[f"`{c}`" for c in cols]).collect())
    other = _cells(relation.project(", ".join(f'"{c}"' for c in cols)).fetchall())
    if len(mine) != len(other):
        return f"{len(mine)} rows != {len(other)} rows"
    bad = [(a, b) for a, b in zip(mine, other) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, first:\n  spark {bad[0][0]}\n  sql   {bad[0][1]}"
    return None


def main(sf: str = "0.01", *names: str) -> int:
    import __spark_entry__ as entry
    from lakeloom.session import get_spark

    spark = get_spark(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g",
                      spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{DATA}/sf{sf}"
    con = duck(sf_dir)
    sql, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                problem = differences(df, con.sql(sql[name]))
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
