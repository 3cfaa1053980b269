"""python -m tests.check [sf_dir] [query ...]: compare queries with their SQL twins."""

from __future__ import annotations

import sys
import time

from geopanel.catalog import ORACLES, QUERIES
from geopanel.session import build_session
from tests.oracle import compare, connect


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark = build_session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problems = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
            else:
                problems = [] if QUERIES[name](spark, sf_dir).count() else ["no rows"]
        except Exception as error:  # report every query, whatever happens to one
            problems = [f"{type(error).__name__}: {str(error)[:900]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {time.time() - start:6.2f}s {name}", flush=True)
        for p in problems:
            print("      ", p)
    print(f"{failed} failed of {len(names or QUERIES)}")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
