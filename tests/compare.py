"""Rows of Spark and DuckDB in one comparable form."""

import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, float) and v != v:
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((str(k), plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(repr(tuple(plain(r[c]) for c in names)) for r in df.collect())


def duck(sf_dir, **replaced):
    con = duckdb.connect()
    for t in TABLES:
        if t not in replaced:
            con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    for t, frame in replaced.items():
        con.register(t, frame)
    return con


def sql_rows(con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(repr(tuple(plain(row[i]) for i in order)) for row in found.fetchall())
