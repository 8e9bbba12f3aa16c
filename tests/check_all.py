"""Run every registered query against its SQL: python tests/check_all.py [sf] [name...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, connect  # noqa: E402
from tidemark.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
directory = f"/root/testdata/sf{sf}"
spark = build_session(
    "check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(directory)
sql = entry.oracle_sql()
bad = 0
names = [n for n in entry.queries() if not sys.argv[2:] or n in sys.argv[2:]]
print("without SQL:", [n for n in names if n not in sql], flush=True)
for name in names:
    start = time.time()
    try:
        df = entry.queries()[name](spark, directory)
        if name in sql:
            n, problems = compare(df, con, sql[name])
        else:
            n, problems = df.count(), []
    except Exception as e:  # noqa: BLE001
        n, problems = -1, [str(e)[:600]]
    bad += bool(problems)
    print(f"{'BAD ' if problems else 'ok  '}{name} {n} {time.time() - start:.1f}s", flush=True)
    for p in problems:
        print("    ", p, flush=True)
print("bad:", bad)
