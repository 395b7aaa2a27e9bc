"""Compare registered queries with their SQL on one data folder.

    python -m zonereach.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])

    def cell(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, float):
            return "0.0" if v == 0 else repr(v)
        if isinstance(v, (datetime.date, datetime.datetime)):
            return str(v)
        if isinstance(v, (list, tuple)):
            return "[" + ",".join(cell(x) for x in v) + "]"
        return f"{type(v).__name__}:{v}"

    return sorted(tuple(cell(r[k]) for k in order) for r in rows), [names[k] for k in order]


def compare(spark, con, name: str, fn, sql: str | None, folder: str) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, folder)
    rows, cols = canonical([tuple(r) for r in df.collect()], df.columns)
    took = time.time() - start
    if sql is None:
        return len(rows) > 0, f"{name}: {len(rows)} rows, no SQL ({took:.1f}s)"
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want, want_cols = canonical(cur.fetchall(), want_names)
    if cols != want_cols:
        return False, f"{name}: columns {cols} != {want_cols}"
    if rows != want:
        extra, lost = set(rows) - set(want), set(want) - set(rows)
        return False, (
            f"{name}: {len(rows)} rows against {len(want)}; {cols}\n  only here {sorted(extra)[:3]}\n  only SQL {sorted(lost)[:3]}"
            f"\n  {len(extra)} / {len(lost)} differ"
        )
    return True, f"{name}: {len(rows)} rows ok ({took:.1f}s)"


def main() -> int:
    from .conformance import ORACLES, QUERIES, bind
    from .session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(folder)
    bad = 0
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        try:
            ok, text = compare(spark, con, name, bind(fn), ORACLES.get(name), folder)
        except Exception as e:  # report and go on with the next query
            ok, text = False, f"{name}: {type(e).__name__}: {str(e)[:1500]}"
        bad += not ok
        print("ok  " if ok else "FAIL", text, flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
