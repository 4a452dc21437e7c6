"""Run every registered query against its SQL twin.

As a script: ``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from tidemark.plans.fixtures import BASE_TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


ROWS: dict[str, int] = {}


def plain(v):
    """Values both engines write alike; the type stays part of the value."""
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return f"decimal {v}"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(plain(r[i]) for i in order) for r in records)


def check(spark, con, name: str, sf_dir: str) -> str | None:
    """None when Spark and SQL agree, else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    got = table(df.columns, df.collect())
    ROWS[name] = len(got[1])
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None
    cur = con.execute(sql)
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"first difference:\n  spark {a}\n  sql   {b}"
    return None


def main() -> None:
    from tidemark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = check(spark, con, name, sf_dir)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} {time.time() - start:.2f}s "
              f"{ROWS.get(name)} rows {problem or ''}",
              flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
