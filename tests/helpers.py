from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    res = con.execute(sql)
    return [d[0] for d in res.description], res.fetchall()


def assert_same(df, con, sql):
    c1, r1 = spark_rows(df)
    c2, r2 = duck_rows(con, sql)
    assert sorted(c1) == sorted(c2), (c1, c2)
    m1, m2 = multiset(c1, r1), multiset(c2, r2)
    assert len(r1) == len(r2), (len(r1), len(r2))
    assert m1 == m2, (list((m1 - m2).items())[:3], list((m2 - m1).items())[:3])
