"""Run every registered query on Spark and its oracle SQL on DuckDB; compare
row count, column names and values (order-insensitive, exact after the
query's own rounding). Usage: python tests/oracle_check.py [sf_dir] [name ...]"""
from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time() else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    msgs = []
    if sorted(s_cols) != sorted(d_cols):
        msgs.append(f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))} "
                    f"duck-only {sorted(set(d_cols) - set(s_cols))}")
    if len(s_rows) != len(d_rows):
        msgs.append(f"rows {len(s_rows)} vs {len(d_rows)}")
    if not msgs:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            names = sorted(s_cols)
            x, y = bad[0]
            diff = [(names[i], x[i], y[i]) for i in range(len(names)) if x[i] != y[i]]
            msgs.append(f"{len(bad)} rows differ, e.g. {diff[:4]}")
    return msgs, len(s_rows), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from panelcast.session import build_session
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    ok = fail = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name}: {n} rows (no oracle) {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            msgs, n, secs = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            msgs, n, secs = [f"ERROR {type(e).__name__}: {str(e)[:400]}"], -1, 0
        if msgs:
            fail += 1
            print(f"FAIL  {name}: {'; '.join(msgs)}", flush=True)
        else:
            ok += 1
            print(f"OK    {name}: {n} rows {secs:.1f}s", flush=True)
    print(f"{ok} ok, {fail} failed")
    return fail


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
