"""Run every registered query against its DuckDB oracle: python -m tests.run_oracle [sf_dir] [keys...]"""

from __future__ import annotations

import sys
import time
import traceback

from tests.compare import compare, duck


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as entry
    from tillroll.session import local_session

    spark = local_session(8)
    con = duck(sf)
    qs, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            ok, msg = compare(fn(spark, sf), con, sql[name]) if name in sql else (True, "no oracle")
            if not ok:
                ok2, msg2 = compare(fn(spark, sf), con, sql[name], digits=6)
                msg += f" | rounded(6): {ok2}"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
            traceback.print_exc(limit=3)
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:24s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main(sys.argv)
