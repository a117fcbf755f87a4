"""Run queries beside their SQL and compare: python tests/oracle.py [folder] [name ...]."""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return str(v) if not isinstance(v, int) else v


def kinds(types):
    out = []
    for t in types:
        t = str(t).lower()
        out.append("int" if t in ("bigint", "long", "int64", "int", "integer") else "float" if t in ("double", "float64") else
                   "bool" if t.startswith("bool") else "str" if t in ("string", "varchar") else t)
    return out


def compare(spark, sf, name, run, sql):
    t = time.time()
    df = run(spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cols, took = df.columns, time.time() - t
    if sql is None:
        return len(rows) > 0, f"{len(rows)} rows (no SQL)", took
    con = duckdb.connect()
    for x in TABLES:
        con.execute(f"CREATE VIEW {x} AS SELECT * FROM '{sf}/{x}.parquet'")
    cur = con.execute(sql)
    want_cols, want_types = [d[0] for d in cur.description], [d[1] for d in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(want_cols):
        return False, f"columns {sorted(cols)} != {sorted(want_cols)}", took
    order, worder = sorted(cols), sorted(want_cols)
    kt = dict(zip(cols, kinds([f.dataType.simpleString() for f in df.schema])))
    wt = dict(zip(want_cols, kinds(want_types)))
    off = {c: (kt[c], wt[c]) for c in order if kt[c] != wt[c]}
    a = sorted((tuple(canon(r[cols.index(c)]) for c in order) for r in rows), key=repr)
    b = sorted((tuple(canon(r[want_cols.index(c)]) for c in worder) for r in want), key=repr)
    if len(a) != len(b):
        return False, f"{len(a)} rows != {len(b)}", took
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} of {len(a)} rows differ, cols {order}: {bad[0]}", took
    if off:
        return False, f"types differ {off}", took
    if not a:
        return False, "no rows", took
    return True, f"{len(a)} rows", took


def session(cores: int = 8, partitions: int = 8):
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(partitions))
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    s.sparkContext.setLogLevel("OFF")
    return s


if __name__ == "__main__":
    import __spark_entry__ as e
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = session(int(os.environ.get("CORES", "8")))
    qs, sq = e.queries(), e.oracle_sql()
    names = [n for n in qs if len(sys.argv) < 3 or any(n.startswith(x) for x in sys.argv[2:])]
    good = 0
    for n in names:
        try:
            ok, msg, took = compare(spark, sf, n, qs[n], sq.get(n))
        except Exception as ex:  # a report, not a test
            ok, msg, took = False, f"{type(ex).__name__}: {str(ex)[:600]}".replace("\n", " "), 0
        good += ok
        print(f"{'ok  ' if ok else 'FAIL'} {n:32s} {took:6.2f}s {msg[:900]}", flush=True)
    print(f"{good} of {len(names)}")
