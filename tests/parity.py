"""Spark vs DuckDB comparison for the registered queries.

Usage: python tests/parity.py [sf_dir] [query ...]
Compares column names, row counts and an order-insensitive hash of the
values (floats compared after the rounding both sides apply).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        if math.isnan(v):
            return "null"
        if v == 0:
            v = 0.0
        return repr(round(v, 9))
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).tz_localize(None).isoformat() if pd.Timestamp(v).tzinfo else pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out)


def digest(rows: list[tuple]) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update("|".join(r).encode())
        h.update(b"\n")
    return h.hexdigest()[:16]


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    s_pdf = fn(spark, sf_dir).toPandas()
    ts = time.time() - t
    t = time.time()
    d_pdf = con.execute(sql).df()
    td = time.time() - t
    s_cols, d_cols = sorted(s_pdf.columns), sorted(d_pdf.columns)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_pdf) != len(d_pdf):
        return False, f"rows differ: spark={len(s_pdf)} duck={len(d_pdf)}"
    a, b = rows_of(s_pdf), rows_of(d_pdf)
    if digest(a) != digest(b):
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ (cols {s_cols}): {diff}"
    return True, f"rows={len(s_pdf)} spark={ts:.1f}s duck={td:.1f}s"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from cellflux.catalog import queries
    from cellflux.oracle import oracle_sql
    from cellflux.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"SKIP {name}: no oracle", flush=True)
            continue
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {name}: {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
