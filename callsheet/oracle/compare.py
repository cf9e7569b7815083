"""Compare a Spark result with DuckDB SQL over the driver parquet views.

Same checks as the correctness gate: row count, column names, and an
order-insensitive comparison of the values (floats rounded).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str, tables: list[str] | None = None):
    import duckdb

    con = duckdb.connect()
    for t in tables or DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def compare(spark_df, con, sql: str, max_diffs: int = 5) -> dict:
    """Returns a dict with ok / counts / column lists / sample differences."""
    srows = [tuple(r) for r in spark_df.collect()]
    scols = list(spark_df.columns)
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    out = {"spark_rows": len(srows), "oracle_rows": len(drows), "spark_cols": scols, "oracle_cols": dcols}
    if sorted(scols) != sorted(dcols):
        out["ok"] = False
        out["why"] = "columns differ"
        return out
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = [dcols.index(scols[i]) for i in order]
    s = sorted((tuple(_norm(r[i]) for i in order) for r in srows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in dorder) for r in drows), key=_key)
    out["ok"] = s == d
    if not out["ok"]:
        ss, ds = set(s), set(d)
        out["only_spark"] = [x for x in s if x not in ds][:max_diffs]
        out["only_oracle"] = [x for x in d if x not in ss][:max_diffs]
        out["sorted_cols"] = [scols[i] for i in order]
    return out
