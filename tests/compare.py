"""Run registered queries on Spark and their SQL on DuckDB, and compare names and values.

    python tests/compare.py /root/testdata/sf0.01 [query …]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value) -> str:
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return f"b{int(value)}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"f{value!r}"
    if isinstance(value, decimal.Decimal):
        return f"d{value}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def digest(rows: list[tuple], columns: list[str]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_plain(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.md5("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when both agree, else what differs."""
    df = query(spark, sf_dir)
    left = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "NestedLoop" in plan or "CartesianProduct" in plan:
        return "the plan pairs every row with every row"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    right = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    if digest(left, df.columns) == digest(right, columns):
        return None
    order = [columns.index(c) for c in df.columns]
    a = {tuple(_plain(v) for v in r) for r in left}
    b = {tuple(_plain(r[i]) for i in order) for r in right}
    return f"{len(left)} and {len(right)} rows; only Spark: {sorted(a - b)[:2]}; only SQL: {sorted(b - a)[:2]}"


def main() -> None:
    import __spark_entry__ as entry
    from medalith.session import local_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(oracles)), "without query:", sorted(set(oracles) - set(queries)))
    bad = 0
    for name in chosen or queries:
        start = time.time()
        try:
            problem = compare(spark, con, name, queries[name], oracles[name], sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__} {str(error)[:600]}"
        bad += problem is not None
        print("ok  " if problem is None else "FAIL", name, f"{time.time() - start:.1f}s", problem or "", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
