"""Run every registered query against its oracle: ``python tests/check_all.py SF_DIR [key...]``."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from compare import compare, duck  # noqa: E402
from nightledger.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
only = set(sys.argv[2:])
spark = build_session()
con = duck(sf)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for k, fn in qs.items():
    if only and k not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if k in sqls:
            r = compare(df, con, sqls[k])
        else:
            r = {"spark_rows": df.count(), "match": None}
    except Exception as e:  # report and continue
        r = {"error": repr(e)[:400], "match": False}
    r["sec"] = round(time.time() - t, 2)
    bad += r.get("match") is False
    print(k, json.dumps(r, default=str), flush=True)
print("FAILED", bad)
