"""Run registered queries and their oracle side by side.

    python tests/oracle_check.py FOLDER [name ...]
"""
from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from martkit.sources.carriers import DRIVER_TABLES  # noqa: E402


def connect(folder: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0) if v else "0.0"
    return str(v)


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, query, sql) -> tuple[bool, str]:
    t0 = time.time()
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    want_names, want = _table([d[0] for d in cur.description], cur.fetchall())
    names, got = _table(df.columns, rows)
    note = f"{len(got)} rows {t1 - t0:.1f}s"
    if names != want_names:
        return False, f"{note}; columns {sorted(set(names) ^ set(want_names))}"
    if got != want:
        diff = [(a, b) for a, b in zip(got, want) if a != b][:1]
        detail = [(n, x, y) for a, b in diff for n, x, y in zip(names, a, b) if x != y]
        bad = sum(a != b for a, b in zip(got, want))
        return False, f"{note}; want {len(want)}; {bad} differ; {detail[:6]}"
    return True, note


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from martkit.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        if name not in sql:
            t0 = time.time()
            try:
                print(f"----  {name}: {query(spark, folder).count()} rows, no oracle {time.time() - t0:.1f}s", flush=True)
            except Exception as exc:
                failed += 1
                print(f"FAIL  {name}: {type(exc).__name__}: {str(exc)[:600]}", flush=True)
            continue
        try:
            ok, note = compare(spark, con, folder, name, query, sql[name])
        except Exception as exc:  # report and go on
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += not ok
        print(f"{'ok' if ok else 'FAIL':5} {name}: {note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
