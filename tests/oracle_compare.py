"""Run registered Spark queries and their DuckDB oracle SQL on the same
parquet tables and compare row count, column names and an order-insensitive
hash of the values. Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v)) if False else str(v)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [cols[i] for i in order], lines, h


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or sorted(qs)):
        if name not in os_:
            results[name] = ("no-oracle", None)
            continue
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # report and go on
            results[name] = ("ERROR", str(e).splitlines()[0][:300])
            print(f"{name:28s} ERROR {results[name][1]}", flush=True)
            continue
        t1 = time.time()
        cur = con.execute(os_[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        t2 = time.time()
        sc, sl, sh = digest(sdf.columns, srows)
        dc, dl, dh = digest(dcols, drows)
        ok = sc == dc and len(sl) == len(dl) and sh == dh
        results[name] = ("ok" if ok else "MISMATCH", (len(sl), len(dl)))
        if verbose:
            print(f"{name:28s} {'ok' if ok else 'MISMATCH'} rows spark={len(sl)} duck={len(dl)} "
                  f"spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s", flush=True)
            if not ok:
                if sc != dc:
                    print("   cols spark:", sc, "\n   cols duck: ", dc)
                sd = set(sl) - set(dl)
                ds = set(dl) - set(sl)
                for x in list(sd)[:3]:
                    print("   spark only:", x[:300])
                for x in list(ds)[:3]:
                    print("   duck only: ", x[:300])
    return results


if __name__ == "__main__":
    from shoal.session import build_session
    spark = build_session()
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("mismatches:", bad)
