"""Compare registered Spark queries with their DuckDB oracles.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Prints one line per query: row counts, column names and whether the sorted
values match exactly (and within 1e-9 relative when not exact).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM "
                    f"read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return v.item()
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def rows_of(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records),
                  key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def close(a, b):
    if a == b:
        return True
    if isinstance(a, float) and isinstance(b, (int, float)):
        return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    if isinstance(b, float) and isinstance(a, int):
        return abs(a - b) <= 1e-9 * max(1.0, abs(b))
    return False


def compare(spark, con, name, fn, oracle_sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    st = time.time() - t
    scols = sorted(sdf.columns)
    t = time.time()
    cur = con.execute(oracle_sql)
    names = [d[0] for d in cur.description]
    orecs = [dict(zip(names, r)) for r in cur.fetchall()]
    ot = time.time() - t
    ocols = sorted(names)
    res = {"name": name, "spark_rows": len(srows), "oracle_rows": len(orecs),
           "cols_match": scols == ocols, "spark_s": round(st, 2),
           "oracle_s": round(ot, 2)}
    if scols != ocols:
        res["spark_cols"] = scols
        res["oracle_cols"] = ocols
        return res
    a = rows_of(srows, scols)
    o = rows_of(orecs, scols)
    res["exact"] = a == o
    if not res["exact"] and len(a) == len(o):
        bad = [(x, y) for x, y in zip(a, o)
               if not all(close(p, q) for p, q in zip(x, y))]
        res["approx"] = not bad
        res["n_bad"] = len(bad)
        if bad:
            res["first_bad"] = bad[0]
    return res


def main(argv):
    sys.path.insert(0, ".")
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from pricelake.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    qs = entry.queries()
    orc = entry.oracle_sql()
    ok = True
    for name in names or list(qs):
        if name not in orc:
            print({"name": name, "oracle": None})
            continue
        try:
            r = compare(spark, con, name, qs[name], orc[name], sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "error": repr(exc)[:500]}
        good = r.get("exact") and r["spark_rows"] == r["oracle_rows"]
        ok = ok and bool(good)
        print(("OK  " if good else "BAD ") + str(r), flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
