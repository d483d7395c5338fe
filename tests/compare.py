"""Comparing a Spark query with its SQL in DuckDB."""

import os

import duckdb


def _rows(df, columns):
    df = df[columns].copy()
    for c in columns:
        if str(df[c].dtype).startswith("datetime") or df[c].map(lambda v: hasattr(v, "isoformat")).any():
            df[c] = df[c].astype(str).str[:10]
    df = df.astype(object).where(df.notna(), None)
    whole = df.map(lambda v: int(v) if isinstance(v, float) and v == int(v) else v)
    return sorted(map(repr, whole.values.tolist()))


def same_rows(spark, query, sql, sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    want, got = con.sql(sql).df(), query(spark, sf_dir).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert _rows(got, columns) == _rows(want, columns)
