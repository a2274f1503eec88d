"""Print the formatted physical plan of registered queries.

usage: python tools/explain.py [sf_dir] [name ...]
"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from nestfold.plans import QUERIES
from nestfold.session import builder

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or sorted(QUERIES)
spark = builder("local[8]").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
for n in names:
    print(f"===== {n}", flush=True)
    QUERIES[n](spark, sf).explain("formatted")
