"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        r = round(f, 9)
        return 0.0 if r == 0 else r
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    canon_rows = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return names, canon_rows


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def diff(spark_result, duck_result, limit=5):
    s_cols, s_rows = canon(*spark_result)
    d_cols, d_rows = canon(*duck_result)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
        return problems
    if len(s_rows) != len(d_rows):
        problems.append(f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}")
    s_set, d_set = {}, {}
    for r in s_rows:
        s_set[r] = s_set.get(r, 0) + 1
    for r in d_rows:
        d_set[r] = d_set.get(r, 0) + 1
    only_s = [r for r in s_set if s_set[r] != d_set.get(r, 0)]
    only_d = [r for r in d_set if d_set[r] != s_set.get(r, 0)]
    if only_s or only_d:
        problems.append(f"values differ: spark-only={only_s[:limit]} duck-only={only_d[:limit]}")
    return problems
