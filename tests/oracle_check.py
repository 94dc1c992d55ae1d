"""Run registered queries in Spark and their SQL oracles in DuckDB and
compare row count, column names and the multiset of rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb  # noqa: I001
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, sf_dir: str, con=None, tol: float = 0.0) -> tuple[bool, str]:
    from fmspark.plans.queries import QUERIES
    from fmspark.plans.oracle_sql import ORACLES
    con = con or duck(sf_dir)
    t = time.time()
    s = QUERIES[name](spark, sf_dir).toPandas()
    ts = time.time() - t
    o = con.execute(ORACLES[name]).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"row count spark={len(s)} oracle={len(o)}"
    rs, ro = _rows(s), _rows(o)
    bad = 0
    maxd = 0.0
    first = None
    for a, b in zip(rs, ro):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, (float, int)) or isinstance(y, float) and isinstance(x, (float, int)):
                d = abs(float(x) - float(y))
                maxd = max(maxd, d)
                if d > tol:
                    bad += 1
                    first = first or (a, b)
            elif x != y:
                bad += 1
                first = first or (a, b)
    if bad:
        return False, f"{bad} values differ (max float diff {maxd}); first: {first}"
    return True, f"ok rows={len(s)} spark {ts:.1f}s"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from fmspark.session import local_session
    from fmspark.plans.oracle_sql import ORACLES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(ORACLES)
    spark = local_session()
    con = duck(sf)
    for n in names:
        try:
            ok, msg = compare(spark, n, sf, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        print(("PASS " if ok else "FAIL ") + n + ": " + msg, flush=True)
