"""Compare registered queries with their SQL on the same tables.

    python tests/oracle_check.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if value != value else f"{value:.9g}"
    if value is None:
        return ""
    return repr(value)


KINDS = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def compare(spark, con, sf: str, fn, sql: str) -> tuple[str, int]:
    """('ok' or a description of the difference, rows)."""
    df = fn(spark, sf)
    cols = sorted(df.columns)
    rel = con.sql(sql)
    if cols != sorted(rel.columns):
        return f"columns {cols} vs {sorted(rel.columns)}", -1
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    bad = [
        (c, t, kinds[c]) for c, t in df.dtypes if KINDS.get(t) != kinds[c]
    ]
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    order = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())
    if len(got) != len(want):
        extra = [g for g in got if g not in set(want)][:2]
        miss = [w for w in want if w not in set(got)][:2]
        return f"rows {len(got)} vs {len(want)}; only spark {extra}; only sql {miss} {cols}", len(got)
    if got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(diff)} rows differ, e.g. {cols} {diff[:2]}", len(got)
    if bad:
        return f"types {bad}", len(got)
    return "ok", len(got)


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    import __spark_entry__ as entry
    from quorumlens.session import local_session

    spark = local_session()
    con = connect(opts.sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if opts.names and not any(name.startswith(p) for p in opts.names):
            continue
        start = time.time()
        try:
            if name in sqls:
                result, rows = compare(spark, con, opts.sf, fn, sqls[name])
            else:
                rows = len(fn(spark, opts.sf).collect())
                result = "rows only"
        except Exception as error:  # noqa: BLE001
            result, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        good = result in ("ok", "rows only")
        failed += not good
        print(f"{'  ' if good else '! '}{name:42s} {rows:7d} {time.time() - start:5.1f}s {result}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
