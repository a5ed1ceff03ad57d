"""Run every registered query against its oracle: python tests/run_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from mercato.session import local_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sql = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sql:
                ok, msg = compare(df, con, sql[name])
            else:
                n = df.count()
                ok, msg = True, f"rows-only: {n} rows"
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:400]}"
        failures += not ok
        print(f"{'PASS' if ok else 'FAIL'} {name:32s} {time.time() - t0:6.2f}s  {msg}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
