"""All queries against their SQL: python tests/check_all.py [sf_dir] [name ...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402
from tidemill.session import local_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con = local_session(cores=8), connect(sf_dir)
    oracles, bad = contract.oracle_sql(), []
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            if name in oracles:
                rows, difference = compare(run(spark, sf_dir), con, oracles[name])
            else:
                rows, difference = run(spark, sf_dir).count(), None
        except Exception:
            rows, difference = -1, traceback.format_exc(limit=3)[-1800:]
        print(f"{name:28} {rows:8} rows {time.time() - began:6.2f}s {'ok' if difference is None else 'DIFFERS'}")
        if difference:
            bad.append(name)
            print("   ", difference)
    print(f"{len(bad)} differ: {bad}")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
