"""Compare a Spark result with a DuckDB oracle: row count, column names and an
order-insensitive hash of the values (columns sorted by name, floats rounded)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib

import os

import duckdb

from sparkrisk.fixtures import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        # ORACLE_EXACT=1 compares floats bit for bit (no rounding).
        return v + 0.0 if os.environ.get("ORACLE_EXACT") else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def table_digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(normed).encode()).hexdigest()
    return [columns[i] for i in order], len(rows), h, normed


# Spark type names and the DuckDB names of the same types.
SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "array<int>": "INTEGER[]",
    "array<string>": "VARCHAR[]", "array<bigint>": "BIGINT[]", "array<double>": "DOUBLE[]",
}


def duck(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(sql)
    types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    return list(rel.columns), rel.fetchall(), types


def compare(df, sql: str, sf_dir: str):
    """Return (ok, message): column names, column types, row count, value hash."""
    s_cols, s_n, s_h, s_rows = table_digest(df.columns, df.collect())
    d_cols, d_rows_raw, d_types = duck(sql, sf_dir)
    d_cols, d_n, d_h, d_rows = table_digest(d_cols, d_rows_raw)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    s_types = {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes}
    type_diff = {n: (s_types[n], d_types[n]) for n in s_cols if s_types[n] != d_types[n]}
    if type_diff:
        return False, f"types differ (spark, duckdb): {type_diff}"
    if s_n != d_n:
        return False, f"row counts differ: spark={s_n} duckdb={d_n}"
    if s_h != d_h:
        only_s = sorted(set(s_rows) - set(d_rows))[:3]
        only_d = sorted(set(d_rows) - set(s_rows))[:3]
        return False, f"values differ; spark-only {only_s}; duckdb-only {only_d}"
    return True, f"{s_n} rows"
