"""Compare every registered query with its SQL twin: ``python tests/check_oracles.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from tests.oracle import compare, duck, session  # noqa: E402


def main() -> int:
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(contract.queries())
    spark, db, oracles, failed = session(), duck(sf_dir), contract.oracle_sql(), 0
    for name in names:
        started = time.time()
        try:
            frame = contract.queries()[name](spark, sf_dir).toPandas()
            took = time.time() - started
            outcome = f"rows only ({len(frame)})" if name not in oracles else compare(frame, db, oracles[name])
            if name not in oracles:
                print(frame.to_string())
        except Exception as error:  # noqa: BLE001 - report and go on
            took, outcome = time.time() - started, f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += not (outcome.startswith("ok") or outcome.startswith("rows only"))
        print(f"{name:32s} {took:7.2f}s  {outcome}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
