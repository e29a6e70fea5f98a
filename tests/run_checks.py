"""python tests/run_checks.py [folder] [name prefix ...]: compare queries with their oracle."""

import sys
import time
import traceback

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

import __spark_entry__ as entry
from checker import compare, connect
from tallyloom.session import local_session


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    good = bad = 0
    slow = []
    for name, build in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in sqls:
                problems = compare(df, con, sqls[name])
            else:
                n = len(df.collect())
                problems = [] if n else ["EMPTY"]
        except Exception as e:  # report and go on
            text = traceback.format_exc() if "-v" in sys.argv else str(e)
            problems = ["FAILED " + text[:700]]
        took = time.time() - start
        slow.append((took, name))
        if problems:
            bad += 1
            print(f"BAD {name} {took:.1f}s", *problems, sep="\n    ", flush=True)
        else:
            good += 1
    print(f"good {good} bad {bad}; slowest", [(n, round(t, 1)) for t, n in sorted(slow, reverse=True)[:8]])


main()
