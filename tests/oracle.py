"""Compare registered queries with their SQL: python tests/oracle.py [sf] [key-prefix ...]"""

import datetime
import decimal
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerleaf import catalog  # noqa: E402
from ledgerleaf.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(norm(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]


def rows_of_sql(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(norm(r[i]) for i in order) for r in rel.fetchall()]


def compare(df, con, sql):
    cols, got = rows_of_spark(df)
    want_cols, want = rows_of_sql(con, sql)
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"

    def key(row):
        return tuple((True, "", 0) if x is None else (False, type(x).__name__, x) for x in row)

    g, w = sorted(got, key=key), sorted(want, key=key)
    if len(g) != len(w):
        return f"rows {len(g)} != {len(w)}; first got {g[:2]} want {w[:2]}"
    bad = [(a, b) for a, b in zip(g, w) if a != b]
    if bad:
        return f"{len(bad)} of {len(g)} rows differ; got {bad[0][0]} want {bad[0][1]}"
    types = [(type(a).__name__, type(b).__name__) for a, b in zip(g[0], w[0])] if g else []
    odd = [(c, t) for c, t in zip(cols, types) if t[0] != t[1] and "NoneType" not in t]
    return f"types {odd}" if odd else None


def _fresh(name):
    return os.path.join(tempfile.mkdtemp(prefix="ledgerleaf-"), name)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=os.environ.get("PARTITIONS", "8"), spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
                          spark__sql__warehouse__dir=_fresh("warehouse"), spark__checkpoint__dir=_fresh("shared"))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = catalog.oracle_sql()
    fails = 0
    for name, fn in catalog.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                verdict = compare(df, con, sqls[name])
            else:
                cols, rows = rows_of_spark(df)
                verdict = None if rows else "no rows"
                print("   ", cols, rows[:2])
        except Exception as e:
            verdict = f"{type(e).__name__}: {str(e)[:700]}"
        fails += verdict is not None
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time()-t:.1f}s {verdict or ''}", flush=True)
    print("failures:", fails)


if __name__ == "__main__":
    main()
