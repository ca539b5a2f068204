"""Order-insensitive comparison of a Spark result with a DuckDB oracle."""

import math

import duckdb

from flowtable.sources.tables import TABLES, table_path


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bytes | bytearray):
        return bytes(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols), (s_cols, d_cols)
    assert len(s_rows) == len(d_rows), (len(s_rows), len(d_rows))
    a = rows_of(s_cols, s_rows)
    b = rows_of(d_cols, d_rows)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    assert not diff, diff[:3]
    return len(a)
