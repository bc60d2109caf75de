"""Comparison of a query with its SQL on one folder of tables."""

import decimal
import glob
import math
import os

SF = "/root/testdata/sf0.001"


def canon(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(float(f"{float(v):.9g}"))
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return str(sorted((str(k), canon(x)) for k, x in v.items()))
    return "[" + ",".join(map(canon, v)) + "]" if isinstance(v, (list, tuple)) else str(v)


def database(d=SF):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in glob.glob(f"{d}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}/*.parquet')" if os.path.isdir(p) else f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


def same(spark, con, query, sql, d=SF):
    df = query(spark, d)
    cols = sorted(df.columns)
    mine = sorted(tuple(map(canon, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert mine == sorted(tuple(canon(r[k]) for k in at) for r in cur.fetchall())
