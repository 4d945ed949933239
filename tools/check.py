"""Run named queries and their SQL checks side by side and report differences.

    python tools/check.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lendlake.plans import catalog  # noqa: E402
from lendlake.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def cell(v) -> str:
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}" if v != int(v) or abs(v) > 1e15 else f"{int(v)}"
    return str(v)


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def kind(t: str) -> str:
    t = t.lower()
    for names, k in (
        (("bigint", "long", "hugeint"), "long"),
        (("int", "integer"), "int"),
        (("double", "float"), "double"),
        (("string", "varchar"), "string"),
        (("bool",), "boolean"),
        (("date",), "date"),
    ):
        if any(t.startswith(n) for n in names):
            return ("hugeint" if t == "hugeint" else k)
    return t


def compare(df, con, sql: str) -> str | None:
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_types = {d[0]: kind(str(d[1])) for d in cur.description}
    want = rows_of(want_cols, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(want_cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    types = {c: (kind(t), want_types[c]) for c, t in df.dtypes if kind(t) != want_types[c]}
    if len(want) != len(got):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, {sorted(df.columns)}: {bad[:2]}"
    if types:
        return f"types differ: {types}"
    return None if got else "no rows"


def main() -> int:
    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    prefixes = tuple(args[1:]) or ("",)
    spark = local_session(os.environ.get("BENCH_CPUS", 8))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    checks = catalog.checks()
    failures = 0
    for name, fn in catalog.queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            problem = compare(df, con, checks[name]) if name in checks else (None if df.count() else "no rows")
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
