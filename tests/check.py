"""Compare registered queries with their twins: python -m tests.check [folder] [name…]."""

import sys
import time

from gridloom.plans.catalog import ORACLE, QUERIES
from gridloom.session import build_session
from tests.oracle import connect, differences


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("8")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    bad = 0
    for name, build in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in ORACLE:
                told = differences(df, con, ORACLE[name])
                rows = df.count() if told is None and wanted else ""
            else:
                rows = len(df.collect())
                told = None
        except Exception as error:
            told, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += told is not None
        mark = "ok  " if told is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.2f}s {rows} {'' if name in ORACLE else '(rows only)'} {told or ''}", flush=True)
    print(f"{bad} failed of {len(QUERIES)}")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
