"""Run registered queries in Spark and their SQL in DuckDB and compare the results.

Usage: ``python -m tests.oracle_harness [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("f", "nan")
        return ("f", round(v, 6) + 0.0)
    if isinstance(v, decimal.Decimal):
        return ("f", round(float(v), 6) + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    if isinstance(v, dict):
        return ("d", tuple(sorted((k, norm(x)) for k, x in v.items())))
    if hasattr(v, "asDict"):
        return ("d", tuple(sorted((k, norm(x)) for k, x in v.asDict().items())))
    return ("s", str(v))


def _key(row):
    return repr(row)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    st = fn(spark, sf_dir).toArrow()
    t1 = time.time()
    dtab = con.sql(sql).arrow()
    if hasattr(dtab, "read_all"):
        dtab = dtab.read_all()
    t2 = time.time()
    scols, dcols = st.column_names, dtab.column_names
    srows = list(zip(*[st.column(c).to_pylist() for c in scols])) if st.num_rows else []
    drows = list(zip(*[dtab.column(c).to_pylist() for c in dcols])) if dtab.num_rows else []
    res = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows), "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(scols) != sorted(dcols):
        res["error"] = f"columns differ: spark={scols} duck={dcols}"
        return res
    stypes = {f.name: str(f.type) for f in st.schema}
    dtypes = {f.name: str(f.type) for f in dtab.schema}
    if stypes != dtypes:
        res["error"] = f"types differ: { {k: (stypes[k], dtypes[k]) for k in stypes if stypes[k] != dtypes[k]} }"
        return res
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    sn = sorted((tuple(norm(r[i]) for i in si) for r in srows), key=_key)
    dn = sorted((tuple(norm(r[i]) for i in di) for r in drows), key=_key)
    if sn != dn:
        sset, dset = set(map(_key, sn)), set(map(_key, dn))
        only_s = [r for r in sn if _key(r) not in dset][:3]
        only_d = [r for r in dn if _key(r) not in sset][:3]
        res["error"] = f"values differ (cols {order}): spark-only {only_s} duck-only {only_d}"
    return res


def main(argv):
    sf_dir = argv[0] if argv and argv[0].startswith("/") else os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    names = [a for a in argv if not a.startswith("/")]
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from rollwise.plans import registry
    from rollwise.session import local_session

    registry.load_all()
    spark = local_session(8, 8)
    con = duck(sf_dir)
    bad = 0
    for name, fn in registry.QUERIES.items():
        if names and name not in names:
            continue
        sql = registry.ORACLE_SQL.get(name)
        if sql is None:
            n = fn(spark, sf_dir).count()
            print(f"SKIP-SQL {name}: spark rows={n}")
            continue
        try:
            r = compare(spark, con, name, fn, sql, sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:600]}"}
        ok = "error" not in r
        bad += not ok
        print(("OK  " if ok else "FAIL"), r, flush=True)
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
