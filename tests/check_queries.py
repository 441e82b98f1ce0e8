"""Run named queries against their SQL twins: ``python tests/check_queries.py FOLDER [NAME ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from compare import connect, difference  # noqa: E402

from weftline.plans import all_queries, all_sql  # noqa: E402
from weftline.session import build_session  # noqa: E402


def main(folder: str, wanted: list[str]) -> int:
    spark = build_session(
        "check", "local[8]", 8, spark__ui__enabled=False, spark__ui__showConsoleProgress=False,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = connect(folder), all_queries(), all_sql()
    failed = []
    for name in wanted or list(queries):
        began = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sql:
                problem, rows = difference(df, con, sql[name]), ""
            else:
                problem, rows = None, f"{len(df.collect())} rows"
        except Exception:
            problem = traceback.format_exc(limit=4)[-1500:]
        if problem:
            failed.append(name)
        print(f"{name:28} {time.time() - began:6.2f}s {'FAIL ' + problem if problem else 'ok ' + rows}", flush=True)
    print(f"{len(failed)} failed: {' '.join(failed)}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
