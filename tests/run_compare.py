"""Compare some or all registered queries by hand: ``python tests/run_compare.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import compare, connect  # noqa: E402
from newsflow.session import local_session  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

if __name__ == "__main__":
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, con, oracle[name]) if name in oracle else f"rows only: {df.count()}"
        except Exception as failure:  # noqa: BLE001
            problem = f"{type(failure).__name__}: {str(failure)[:700]}"
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
