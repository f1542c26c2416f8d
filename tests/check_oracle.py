"""Run all (or named) queries against their SQL at one scale: check_oracle.py SF [names]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences  # noqa: E402
from tillbook.session import local_session  # noqa: E402

sf_dir = f"/root/testdata/sf{sys.argv[1]}"
spark = local_session(8)
con = connect(sf_dir)
queries, sql = entry.queries(), entry.oracle_sql()
names = sys.argv[2:] or list(queries)
print("without SQL:", sorted(set(queries) - set(sql)), "without query:", sorted(set(sql) - set(queries)))
bad = 0
for name in names:
    start = time.time()
    try:
        df = queries[name](spark, sf_dir)
        found = differences(df, con, sql[name])
        n = df.count()
    except Exception as e:  # noqa: BLE001
        found, n = [f"{type(e).__name__}: {str(e)[:600]}"], -1
    bad += bool(found)
    print(f"{'FAIL' if found else 'ok  '} {name} rows={n} {time.time() - start:.2f}s", *found, sep="\n     " if found else " ")
print("failed:", bad, "of", len(names))
