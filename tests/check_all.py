"""``python tests/check_all.py [sf_dir] [name …]``: every query against its SQL, with times."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import differences, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tablepull.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            found = differences(df, connection, sql[name]) if name in sql else [f"no SQL, {df.count()} rows"]
        except Exception as error:  # noqa: BLE001
            found = [traceback.format_exc(limit=-4) if os.environ.get("TRACE") else str(error)[:600]]
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - start:.2f}s", *found, sep="\n    " if found else " ", flush=True)
    print("bad:", bad)
