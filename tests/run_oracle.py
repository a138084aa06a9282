"""python tests/run_oracle.py [SF_DIR] [QUERY...]: compares registered queries with their SQL, and runs the others."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]
import __spark_entry__ as entry  # noqa: E402
from oracle import connect, differences  # noqa: E402

from statuteloom.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in sql:
                same, more, less = differences(spark, con, query, sql[name], sf_dir)
                ok = same and not more and not less
                print(f"{'ok  ' if ok else 'DIFF'} {name} {time.time() - began:.1f} s", "" if ok else (same, sum(more.values()), sum(less.values()), list(more)[:4], list(less)[:4]), flush=True)
            else:
                print(f"rows {name} {query(spark, sf_dir).count()} {time.time() - began:.1f} s", flush=True)
        except Exception as e:
            print(f"FAIL {name} {type(e).__name__} {str(e)[:1500]}", flush=True)
        spark.catalog.clearCache()
