"""Run registered queries and compare them with their SQL on the same tables.

Usage: python tests/oracle_compare.py [folder] [name-fragment ...]
"""

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


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "\0null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def kind(t: str) -> str:
    t = t.lower()
    for names, label in [
        (("bigint", "long", "hugeint"), "int64"),
        (("int", "integer"), "int32"),
        (("double",), "double"),
        (("varchar", "string"), "string"),
        (("boolean",), "boolean"),
    ]:
        if t in names:
            return label
    return t


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result, empty when they agree."""
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    right = rows_of(names, cur.fetchall())
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, spark_type in df.dtypes:
        if kind(spark_type) != kind(types[name]):
            out.append(f"type of {name}: {spark_type} vs {types[name]}")
    if len(left) != len(right):
        out.append(f"rows {len(left)} vs {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        out.append(f"{len(bad)} differing rows of {sorted(names)}; first {bad[0][0]} vs {bad[0][1]}")
    return out


def main() -> int:
    import __spark_entry__ as entry
    from statloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    oracle = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in oracle:
                problems = compare(df, con, oracle[name])
                label = "ok  " if not problems else "DIFF"
            else:
                n = len(df.collect())
                problems, label = [f"{n} rows, no SQL"], "rows"
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problems, label = [f"{type(e).__name__}: {str(e)[:1500]}"], "FAIL"
        failed += label in ("DIFF", "FAIL")
        print(f"{label} {time.time() - start:6.2f}s {name} {'; '.join(problems)}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
