"""Compare the subpackage's queries with their twins: python -m tests.llm.check folder [name…]."""

import sys
import time

from gridloom.llm.catalog import LLM_ORACLE, LLM_QUERIES
from gridloom.session import build_session
from tests.oracle import connect, differences


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, build in LLM_QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        df = build(spark, folder)
        told = differences(df, con, LLM_ORACLE[name]) if name in LLM_ORACLE else None
        rows = df.limit(3).collect() if told is None else []
        bad += told is not None
        print("ok  " if told is None else "FAIL", name, f"{time.time() - start:.1f}s", told or rows, flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
