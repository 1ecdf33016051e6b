"""Compare registered queries with their SQL twins, as the outer check does."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _kind(s: pd.Series) -> str:
    k = s.dtype.kind
    if k in "iu" and s.isna().any():
        return "f"  # whole numbers with nulls are floats on one side and nullable integers on the other
    if k == "O" and len(s) and s.map(lambda v: isinstance(v, bool)).all():
        return "b"
    return {"u": "i"}.get(k, "s" if k not in "ifbM" else k)


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="stable", na_position="first").reset_index(drop=True)


def difference(a: pd.DataFrame, b: pd.DataFrame) -> str | None:
    if sorted(a.columns) != sorted(b.columns):
        return f"columns {sorted(a.columns)} and {sorted(b.columns)}"
    if len(a) != len(b):
        return f"rows {len(a)} and {len(b)}"
    for c in a.columns:
        if _kind(a[c]) != _kind(b[c]):
            return f"type of {c}: {a[c].dtype} and {b[c].dtype}"
    a, b = (x.astype({c: "float64" for c in x if _kind(x[c]) == "f"}) for x in (a, b))
    a, b = normal(a), normal(b)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            bad = same[~same].index
            return f"{len(bad)} values of {c}, first {a[c][bad[0]]!r} and {b[c][bad[0]]!r}"
    return None


def check(spark, con, name: str, query, sql: str | None, sf: str) -> tuple[str | None, float, int]:
    start = time.time()
    got = query(spark, sf).toPandas()
    took = time.time() - start
    if sql is None:
        return None, took, len(got)
    cur = con.execute(sql)
    return difference(got, cur.fetchdf()), took, len(got)


def main(argv: list[str]) -> int:
    sf = argv[0]
    only = argv[1:]
    sys.path.insert(0, ".")
    import __spark_entry__ as e

    from clickweave.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8, driver_memory="20g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, query in e.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        try:
            diff, took, n = check(spark, con, name, query, e.oracle_sql().get(name), sf)
        except Exception as x:  # keep going: one line per failing query
            diff, took, n = f"{type(x).__name__}: {str(x)[:600]}", 0.0, 0
        bad += diff is not None
        kind = "rows" if name not in e.oracle_sql() else "sql"
        print(f"{'ok ' if diff is None else 'BAD'} {name} [{kind}] {took:.1f}s {n} rows {diff or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
