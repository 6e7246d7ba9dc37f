"""Runs registered queries next to their SQL twins: python tests/oracle_check.py SF [name-part ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    import decimal
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "null" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if v is None:
        return "null"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return str(v)


def kind(t: str) -> str:
    t = t.lower()
    return {"integer": "int", "double": "double", "varchar": "string", "float": "float"}.get(t, t)


def compare(df, con, sql: str):
    """(matches, note) for a Spark result and an SQL text."""
    start = time.time()
    ours = df.collect()
    mid = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: kind(str(d[1])) for d in cur.description}
    theirs = cur.fetchall()
    print(f"    spark {mid - start:.1f}s sql {time.time() - mid:.1f}s", flush=True)
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    note = [f"{c}:{t}/{types[c]}" for c, t in df.dtypes if kind(t) != types[c]]
    cols = sorted(names)
    left = sorted(tuple(plain(r[c]) for c in cols) for r in ours)
    order = [names.index(c) for c in cols]
    right = sorted(tuple(plain(r[i]) for i in order) for r in theirs)
    if left == right:
        return True, f"{len(left)} rows " + " ".join(note)
    a, b = set(left), set(right)
    return False, (f"{len(left)} vs {len(right)} rows; only ours {sorted(a - b)[:3]}; "
                   f"only theirs {sorted(b - a)[:3]} cols {cols} " + " ".join(note))


def main() -> int:
    import __spark_entry__ as entry
    from folioscore.session import build_session
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    parts = sys.argv[2:]
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad, oracle = [], entry.oracle_sql()
    for name, fn in entry.queries().items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracle:
                ok, note = compare(df, con, oracle[name])
            else:
                rows = len(df.collect())
                ok, note = rows > 0, f"{rows} rows (no SQL)"
        except Exception as e:  # the report lists every failure
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)
    return len(bad)


if __name__ == "__main__":
    sys.exit(main())
