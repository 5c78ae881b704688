"""Run queries and their SQL side by side: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return "null" if value is None else str(value)


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
          "float": "FLOAT", "date": "DATE", "boolean": "BOOLEAN"}


def differences(df, connection, sql: str) -> list[str]:
    """What differs between a Spark result and a DuckDB one; empty if nothing."""
    names = sorted(df.columns)
    ours = sorted(tuple(_cell(r[n]) for n in names) for r in df.collect())
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    rows = result.fetchall()
    problems = []
    if sorted(columns) != names:
        return [f"columns {names} against {sorted(columns)}"]
    order = [columns.index(n) for n in names]
    theirs = sorted(tuple(_cell(r[i]) for i in order) for r in rows)
    kinds = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    for name, dtype in df.dtypes:
        if dtype in _KINDS and kinds[name] != _KINDS[dtype]:
            problems.append(f"type of {name}: {dtype} against {kinds[name]}")
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    if ours != theirs:
        extra, missing = set(ours) - set(theirs), set(theirs) - set(ours)
        problems.append(f"{len(extra)} rows only ours {sorted(extra)[:2]}, "
                        f"{len(missing)} only theirs {sorted(missing)[:2]}")
    return problems


def main():
    import __spark_entry__ as entry
    from tierline.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            problems = differences(run(spark, sf_dir), connection, sql[name])
        except Exception as error:
            problems = [repr(error)[:600]]
        bad += bool(problems)
        print(f"{'DIFF' if problems else 'ok  '} {name} {time.time() - started:.2f}s", *problems, flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
