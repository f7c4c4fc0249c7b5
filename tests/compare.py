"""Run named queries against DuckDB on the same tables: python tests/compare.py [sf] [name ...]."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def database(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def mismatch(spark_df, con, sql):
    """None when both give the same columns and rows, else a short description."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    want = rows_of(names, found.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    off = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(off)} of {len(got)} rows differ, first {off[0]}" if off else None


if __name__ == "__main__":
    import conftest
    from __spark_entry__ import oracle_sql, queries
    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark, con, oracles = conftest.session(), database(sf), oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            problem = mismatch(df, con, oracles[name]) if name in oracles else f"({df.count()} rows, no SQL)"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem) and "no SQL" not in problem
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("bad:", bad)
