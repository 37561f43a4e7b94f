"""Run a registered Spark query and its DuckDB oracle and compare them.

Mirrors the driver's check: same column names, same row count, same multiset
of rows (columns sorted by name, values normalised: NULL/NaN alike, floats to
12 significant digits).  CLI: ``python tests/oracle_harness.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

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
    try:
        import numpy as np
        if isinstance(v, np.generic):
            v = v.item()
    except ImportError:  # pragma: no cover
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return f"{v:.12g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(_norm(x)) for x in v) + "]"
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from varlake.plans.catalog import REGISTRY

    fn, sql = REGISTRY[name]
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["oracle"] = None
        out["match"] = None
        return out
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out["oracle_rows"] = len(d_rows)
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(s_cols) - set(d_cols))
        out["oracle_only"] = sorted(set(d_cols) - set(s_cols))
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["match"] = out["columns_match"] and a == b
    if not out["match"] and out["columns_match"]:
        diff_a = list((a - b).items())[:3]
        diff_b = list((b - a).items())[:3]
        out["spark_extra"] = diff_a
        out["oracle_extra"] = diff_b
        out["columns"] = sorted(s_cols)
    return out


def main(argv):
    from varlake.config import build_session
    from varlake.plans.catalog import REGISTRY

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(REGISTRY)
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
