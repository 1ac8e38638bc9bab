"""Seconds of every claims query's SQL in DuckDB, one run each after a warm-up.

    python tools/time_duckdb.py [sf_dir] [threads]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from carelake.compare import duck  # noqa: E402
from carelake.oracle import all_sql  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    con = duck(sf_dir)
    con.execute(f"SET threads = {threads}")
    out = {}
    for name, sql in all_sql().items():
        if not out:
            con.execute(sql).fetchall()
        t0 = time.perf_counter()
        con.execute(sql).fetchall()
        out[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"total": round(sum(out.values()), 1), "threads": threads, "queries": out}))


if __name__ == "__main__":
    main()
