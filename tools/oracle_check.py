"""Run catalog queries in Spark and their SQL in DuckDB; compare like the driver.

    python tools/oracle_check.py [sf_dir] [name ...]

Prints one line per query: rows, column names, exact value hash, and the
largest numeric difference when hashes differ.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    rows.sort(key=lambda r: tuple("" if x is None else x for x in r))
    return cols, rows


def digest(rows) -> str:
    return hashlib.sha256(repr(rows).encode()).hexdigest()[:12]


def max_diff(a, b):
    worst = 0.0
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if x != y:
                try:
                    worst = max(worst, abs(float(x) - float(y)))
                except (TypeError, ValueError):
                    return f"non-numeric {x!r} vs {y!r}"
    return worst


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from lapse.plans.catalog import oracle_sql, queries
    from lapse.session import local_session
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or qs:
        t0 = time.time()
        try:
            s = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:32s} rows={len(s)} (no oracle) {ts:.1f}s")
            continue
        try:
            d = con.execute(sqls[name]).fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        cs, rs = canon(s)
        cd, rd = canon(d)
        ok = len(s) == len(d) and cs == cd and rs == rd
        msg = "OK " if ok else "BAD"
        extra = ""
        if not ok:
            bad += 1
            if cs != cd:
                extra = f" cols spark-only={sorted(set(cs)-set(cd))} duck-only={sorted(set(cd)-set(cs))}"
            elif len(s) != len(d):
                extra = f" rows {len(s)} vs {len(d)}"
            else:
                n = sum(1 for a, b in zip(rs, rd) if a != b)
                extra = f" {n} rows differ, max diff {max_diff(rs, rd)}"
                for a, b in zip(rs, rd):
                    if a != b:
                        extra += f"\n      spark {a}\n      duck  {b}"
                        break
        print(f"{name:32s} {msg} rows={len(s)} {digest(rs)} {ts:.1f}s{extra}")
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
