"""Run every registered query against its DuckDB oracle: python tests/run_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, duck  # noqa: E402

from casaframe.session import local_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(8)
    con = duck(sf)
    qs, orc = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in orc:
                ok, msg = compare(df, orc[name], con)
            else:
                n = df.count()
                ok, msg = True, f"rows only: {n}"
        except Exception as exc:  # report and continue
            ok, msg = False, f"{type(exc).__name__}: {str(exc)[:600]}"
            traceback.print_exc(limit=3)
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.1f}s  {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
