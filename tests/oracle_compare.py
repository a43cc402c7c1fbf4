"""Compare a Spark result with a DuckDB result the way the driver does:
row count, column names (sorted), and an order-insensitive exact value
comparison."""

from __future__ import annotations

import math


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return cols, out


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
    if len(sr) != len(dr):
        problems.append(f"row count differs: spark={len(sr)} duck={len(dr)}")
    if not problems:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b]
        if diff:
            problems.append(f"{len(diff)} rows differ, e.g. {diff[:3]}")
    return problems, len(sr)
