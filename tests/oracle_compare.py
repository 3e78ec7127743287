"""Compare a Spark result with the DuckDB oracle: rows, column names, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "NULL"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in data]


def compare(df, con, sql) -> dict:
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    res = {"spark_rows": len(sr), "oracle_rows": len(dr), "cols_match": sc == dc}
    if sc != dc:
        res["spark_cols"], res["oracle_cols"] = sc, dc
        res["match"] = False
        return res
    cs, cd = Counter(sr), Counter(dr)
    res["match"] = cs == cd
    if not res["match"]:
        res["only_spark"] = list((cs - cd).elements())[:3]
        res["only_oracle"] = list((cd - cs).elements())[:3]
        res["cols"] = sc
    return res
