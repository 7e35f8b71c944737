"""Run registered queries next to their SQL: `python tests/compare.py [sf] [name ...]`."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """None when both results are equal, else what differs."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    got = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if got == want:
        return None
    a, b = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} rows against {len(want)}; only here {sorted(a)[:3]}; only there {sorted(b)[:3]}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from docsift.session import build_session
    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark = build_session("local[8]", "compare", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name, run in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:] or name not in oracle_sql():
            continue
        t = time.time()
        try:
            diff = difference(run(spark, sf), con, oracle_sql()[name])
            n = len(con.execute(oracle_sql()[name]).fetchall())
        except Exception as e:  # noqa: BLE001
            diff, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name:28s} {n:8d} rows {time.time() - t:6.2f}s {diff or ''}",
              flush=True)
    print("bad:", bad)
