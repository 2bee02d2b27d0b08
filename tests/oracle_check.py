"""Runs queries and their SQL side by side: python tests/oracle_check.py [sf_dir] [names...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def one(v):
        if isinstance(v, float):
            return f"{v:.9g}"
        if isinstance(v, (list, tuple)):
            return str([one(x) for x in v])
        if isinstance(v, dict):
            return str({k: one(x) for k, x in sorted(v.items())})
        return str(v)

    return sorted(tuple(one(r[i]) for i in order) for r in rows)


def compare(spark, duck, name, query, sql, d):
    df = query(spark, d)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return f"{name}: {len(got)} rows, no SQL", True
    cur = duck.execute(sql)
    names = [c[0] for c in cur.description]
    want = canonical(cur.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"{name}: columns {sorted(df.columns)} against {sorted(names)}", False
    if got == want:
        return f"{name}: {len(got)} rows equal", True
    from collections import Counter

    a, b = Counter(got), Counter(want)
    return f"{name}: {len(got)} rows against {len(want)}; only here {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}", False


def connect(d):
    import duckdb

    duck = duckdb.connect()
    duck.execute("SET TimeZone='UTC'")
    for p in sorted(Path(d).glob("*.parquet")):
        duck.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return duck


def main(args):
    import __spark_entry__ as e
    from glossweave.session import local_session

    d = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    duck, sql, bad = connect(d), e.oracle_sql(), 0
    for name, q in e.queries().items():
        if len(args) > 1 and not any(name.startswith(x) for x in args[1:]):
            continue
        began = time.time()
        try:
            said, ok = compare(spark, duck, name, q, sql.get(name), d)
        except Exception as x:
            said, ok = f"{name}: {type(x).__name__} {str(x)[:600]}", False
        bad += not ok
        print("ok  " if ok else "FAIL", f"{time.time() - began:5.1f}s", said, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
