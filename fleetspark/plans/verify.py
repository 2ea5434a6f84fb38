"""Spark-vs-DuckDB comparison used by the tests (the driver's gate in small)."""

from __future__ import annotations

import datetime
import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (pd.Timestamp, datetime.datetime)):
        return v.date().isoformat() if (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0) else v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, sql: str, con) -> dict:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    res = {"rows_spark": len(s), "rows_oracle": len(d),
           "cols_match": sorted(s.columns) == sorted(d.columns)}
    if not res["cols_match"]:
        res["cols"] = (sorted(set(s.columns) - set(d.columns)), sorted(set(d.columns) - set(s.columns)))
        res["ok"] = False
        return res
    rs, rd = _rows(s), _rows(d)
    bad = [(a, b) for a, b in zip(rs, rd) if a != b]
    res["mismatch"] = len(bad) + abs(len(rs) - len(rd))
    res["example"] = bad[:2]
    res["ok"] = res["mismatch"] == 0
    return res
