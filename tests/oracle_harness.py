"""Run registered Spark queries and their DuckDB oracles side by side.

Compares row count, column names and the order-insensitive multiset of rows
(columns sorted by name), the way the external correctness check does.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def compare(spark, sf_dir, name, fn, sql, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "spark_s": t1 - t0}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "spark_s": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        out.update(ok=False, why=f"columns {sorted(scols)} vs {sorted(dcols)}")
        return out
    order_s = sorted(range(len(scols)), key=lambda i: scols[i])
    order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted((tuple(_norm(r[i]) for i in order_s) for r in srows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in order_d) for r in drows), key=_key)
    if len(a) != len(b):
        out.update(ok=False, why="row count")
        return out
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    out["ok"] = not diff
    if diff:
        out["why"] = f"{len(diff)} rows differ, e.g. {diff[:2]} cols={sorted(scols)}"
    return out


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from tidepanel.session import ensure_checkpoint_dir, get_spark
    sf_dir = "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    ensure_checkpoint_dir(spark)
    qs, sqls = E.queries(), E.oracle_sql()
    names = [n for n in qs if not argv or any(n.startswith(p) for p in argv)]
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            res = compare(spark, sf_dir, n, qs[n], sqls.get(n), con)
        except Exception as e:  # noqa: BLE001
            res = {"name": n, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += res.get("ok") is False
        print(res, flush=True)
    print("FAILED", bad, "of", len(names))


if __name__ == "__main__":
    main(sys.argv[1:])
