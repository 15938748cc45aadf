"""Command line check: python tests/run_checks.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry
from flowsieve.session import build_session
from harness import compare, duck


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session(cores="8")
    con = duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        began = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problems = compare(df, con, oracle[name])
                note = "ok" if not problems else "; ".join(problems)
            else:
                note = f"rows {df.count()}"
                problems = []
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems = [str(error)]
            note = "ERROR " + traceback.format_exc()[-1500:]
        bad += bool(problems)
        print(f"{name:26s} {time.time() - began:6.1f}s {note}", flush=True)
    print(f"{bad} with problems")


if __name__ == "__main__":
    main()
