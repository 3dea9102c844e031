"""Compare a Spark DataFrame with a DuckDB query over the same driver tables.

Row multisets are compared order-insensitively after normalising every value
to text (decimals keep their scale, timestamps their ISO form).
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal

import duckdb

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize() if v == v.to_integral() else v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def rows_of_spark(df) -> tuple[list[str], collections.Counter]:
    cols = sorted(df.columns)
    return cols, collections.Counter(tuple(_norm(r[c]) for c in cols) for r in df.toLocalIterator())


def rows_of_duck(con, sql: str) -> tuple[list[str], collections.Counter]:
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    cnt = collections.Counter()
    for row in rel.fetchall():
        cnt[tuple(_norm(row[i]) for i in order)] += 1
    return [names[i] for i in order], cnt


def compare(df, con, sql: str) -> dict:
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(con, sql)
    out = {
        "spark_rows": sum(s_rows.values()),
        "oracle_rows": sum(d_rows.values()),
        "columns_match": s_cols == d_cols,
        "rows_match": s_rows == d_rows,
    }
    if not out["rows_match"]:
        only_s = s_rows - d_rows
        only_d = d_rows - s_rows
        out["only_spark"] = [dict(zip(s_cols, r)) for r in list(only_s)[:2]]
        out["only_oracle"] = [dict(zip(d_cols, r)) for r in list(only_d)[:2]]
        out["n_only_spark"], out["n_only_oracle"] = sum(only_s.values()), sum(only_d.values())
    if not out["columns_match"]:
        out["col_diff"] = sorted(set(s_cols) ^ set(d_cols))
    return out
