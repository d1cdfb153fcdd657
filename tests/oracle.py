"""Compare a query with its SQL on the given tables."""

import math
from pathlib import Path

import duckdb


def _plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(round(x, 6) + 0.0)
    if isinstance(x, list | tuple):
        return str([_plain(y) for y in x])
    return str(x)


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_plain(r[c]) for c in names) for r in df.collect())


def rows_in_sql(sql, sf_dir):
    db = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    got = db.execute(sql)
    names = [c[0] for c in got.description]
    order = sorted(names)
    return order, sorted(tuple(_plain(r[names.index(c)]) for c in order) for r in got.fetchall())
