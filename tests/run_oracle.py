"""CLI: compare every registered query with its oracle at one scale (default sf0.01)."""

import json
import sys
import time
import traceback

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from dqforge.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = local_session(8)
con = duck(sf)
qs, orc = E.queries(), E.oracle_sql()
bad = 0
for name, fn in qs.items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in orc:
            r = compare(df, con, orc[name])
            ok = r["schema_match"] and r["count_match"] and r["value_match"]
        else:
            n = df.count()
            r = {"rows_only": n}
            ok = True
    except Exception as e:  # noqa: BLE001
        traceback.print_exc()
        r = {"error": str(e)[:1500]}
        ok = False
    bad += not ok
    print(("OK  " if ok else "FAIL"), name, f"{time.time() - t:.2f}s",
          json.dumps({k: v for k, v in r.items() if not ok or k in ("spark_rows", "rows_only")}, default=str))
print("failures:", bad)
