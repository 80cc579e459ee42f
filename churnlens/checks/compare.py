"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import hashlib

import pandas as pd

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
               "pages benchmark labels conversations").split()


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v, digits=None) -> str:
    if isinstance(v, (list, tuple, dict)) or (hasattr(v, "tolist") and not hasattr(v, "isoformat")):
        return repr(v.tolist() if hasattr(v, "tolist") else v)
    if v is None or pd.isna(v):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float) and v.is_integer() and abs(v) < 2 ** 53:
        return str(int(v))  # nullable integer columns arrive as float64 from toPandas
    if isinstance(v, float):
        return repr(v) if digits is None else f"{v:.{digits}g}"
    if isinstance(v, (dt.datetime, pd.Timestamp)):
        midnight = (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0)
        return v.date().isoformat() if midnight else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def row_strings(df: pd.DataFrame, digits=None) -> list[str]:
    cols = sorted(df.columns)
    return sorted("|".join(norm(r[c], digits) for c in cols) for r in df[cols].to_dict("records"))


def digest(df: pd.DataFrame, digits=None) -> str:
    return hashlib.sha1("\n".join(row_strings(df, digits)).encode()).hexdigest()


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> tuple[str, str]:
    """('OK' | 'APPROX' | 'MISMATCH', detail)."""
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return "MISMATCH", f"columns {sorted(spark_df.columns)} vs {sorted(oracle_df.columns)}"
    if len(spark_df) != len(oracle_df):
        return "MISMATCH", f"rows {len(spark_df)} vs {len(oracle_df)}"
    if digest(spark_df) == digest(oracle_df):
        return "OK", ""
    a, b = row_strings(spark_df), row_strings(oracle_df)
    detail = f"spark only {sorted(set(a) - set(b))[:2]} duck only {sorted(set(b) - set(a))[:2]}"
    if digest(spark_df, 9) == digest(oracle_df, 9):
        return "APPROX", detail
    return "MISMATCH", detail
