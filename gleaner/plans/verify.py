"""Local stand-in for the driver's correctness gate.

Runs a registered Spark query and its DuckDB oracle on the same parquet
tables and compares row count, column names and an order-insensitive value
hash (floats rounded to 6 places, timestamps as ISO text).
"""

from __future__ import annotations

import hashlib
import math

from gleaner.plans.tables import TABLES


def duck(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.sql(sql).df()


def _norm(v):
    import numpy as np

    if v is None:
        return None
    if isinstance(v, np.generic):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf) -> list[tuple]:
    import pandas as pd

    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(None if (not isinstance(x, (list, tuple)) and not hasattr(x, "tolist")
                                  and pd.isna(x)) else _norm(x) for x in rec))
    return out


def digest(rows: list[tuple]) -> str:
    h = hashlib.sha256()
    for r in sorted(repr(x) for x in rows):
        h.update(r.encode())
    return h.hexdigest()[:16]


def compare(spark, name: str, sf_dir: str) -> dict:
    from gleaner.plans.catalog import ORACLES, QUERIES

    sdf = QUERIES[name](spark, sf_dir)
    sp = sdf.toPandas()
    res = {"name": name, "spark_rows": len(sp), "spark_cols": sorted(sp.columns)}
    if name not in ORACLES:
        res["oracle"] = None
        return res
    dp = duck(ORACLES[name], sf_dir)
    res.update(oracle_rows=len(dp), oracle_cols=sorted(dp.columns))
    a, b = rows_of(sp), rows_of(dp)
    res["match"] = (res["spark_cols"] == res["oracle_cols"] and len(a) == len(b) and digest(a) == digest(b))
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(map(repr, sa - sb))[:3]
        res["only_oracle"] = sorted(map(repr, sb - sa))[:3]
    return res
