"""Compare the registered queries with their SQL in DuckDB: names, types of values, rows.

``python tests/oracle.py [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
import traceback
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if isinstance(value, (bool, str, float, int, type(None))):
        return value
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(r[i]) for i in order) for r in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{folder}/{file}'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    got_names, got = rows_by_name(df.columns, df.collect())
    answer = con.execute(sql)
    want_names, want = rows_by_name([d[0] for d in answer.description], answer.fetchall())
    if got_names != want_names:
        return f"columns {got_names} against {want_names}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"extra {list(extra.items())[:3]} missing {list(missing.items())[:3]}"
        )
    return None


if __name__ == "__main__":
    from tierkit.session import local_session
    import __spark_entry__

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in sys.argv[2:] or list(ORACLES):
        start = time.time()
        try:
            problem = difference(QUERIES[name](spark, folder), con, ORACLES[name])
        except Exception:
            problem = traceback.format_exc()[-1800:]
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s", problem or "", flush=True)
    print("bad:", bad)
    sys.exit(bad > 0)
