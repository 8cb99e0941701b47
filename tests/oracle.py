"""Compare registered queries with their SQL in DuckDB.

Command line: python tests/oracle.py <sf dir> [name prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else repr(number + 0.0)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, else a short account of the difference."""
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if ours[1] != theirs[1]:
        only_ours = sorted(set(ours[1]) - set(theirs[1]))[:3]
        only_theirs = sorted(set(theirs[1]) - set(ours[1]))[:3]
        return f"{len(ours[1])} rows against {len(theirs[1])}\n  ours only: {only_ours}\n  SQL only:  {only_theirs}"
    return None if ours[1] else "EMPTY"


def main() -> int:
    import __spark_entry__ as entry
    from lakeops.session import build_session

    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:]) or ("",)
    spark = build_session(
        "oracle", f"local[{os.cpu_count()}]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failures = connect(sf_dir), 0
    sql = entry.oracle_sql()
    for name, query in entry.queries().items():
        if not name.startswith(prefixes):
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                problem = compare(df, con, sql[name])
            else:
                problem = f"rows only: {df.count()}"
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad = problem is not None and not problem.startswith("rows only")
        failures += bad
        print(f"{'FAIL' if bad else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"failures: {failures}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
