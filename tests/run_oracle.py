"""python tests/run_oracle.py [sf_dir] [name-substring...] — compare every
registered query with its oracle (a quick local version of the gate)."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from harness import compare, duck  # noqa: E402
from finmart import get_spark  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
filters = sys.argv[2:]
spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": os.environ.get("DRIVER_MEMORY", "8g")})
con = duck(sf_dir)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for name, q in qs.items():
    if filters and not any(f in name for f in filters):
        continue
    t = time.time()
    sql = sqls.get(name)
    if sql is None:
        n = q(spark, sf_dir).count()
        print(f"{name:50s} rows={n:7d} (no oracle) {time.time() - t:5.1f}s")
        continue
    try:
        n, problems = compare(spark, con, sf_dir, name, q, sql)
    except Exception as e:  # noqa: BLE001
        n, problems = -1, [f"error: {type(e).__name__}: {str(e)[:400]}"]
    bad += bool(problems)
    print(f"{name:50s} rows={n:7d} {'OK' if not problems else 'FAIL'} {time.time() - t:5.1f}s")
    for p in problems:
        print("    ", p[:1500])
print("failures:", bad)
