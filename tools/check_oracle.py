"""Run registered queries against their DuckDB oracle (local check).

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""
import sys
import time

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))

from nestfold.plans import ORACLES, QUERIES
from nestfold.session import builder
from nestfold.testing import compare, duckdb_conn

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or sorted(QUERIES)
spark = builder("local[8]").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
con = duckdb_conn(sf)
bad = 0
for n in names:
    t = time.time()
    try:
        df = QUERIES[n](spark, sf)
        if n in ORACLES:
            ok, msg = compare(df, con, ORACLES[n])
        else:
            ok, msg = True, f"rows-only: {df.count()} rows"
    except Exception as e:  # report and continue
        ok, msg = False, f"{type(e).__name__}: {str(e)[:800]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {n:28s} {time.time() - t:6.1f}s {msg}", flush=True)
print("failures:", bad)
