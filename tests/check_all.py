"""Compare every query with its SQL: ``python tests/check_all.py [sf] [name ...]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as E  # noqa: E402
from supplylens.session import build_session  # noqa: E402
from tests.compare import database, differences  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    root = f"/root/testdata/sf{sf}"
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sqls = database(root), E.queries(), E.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, root)
            odd = differences(df, con, sqls[name]) if name in sqls else [f"no sql, {df.count()} rows"]
        except Exception as exc:  # report and go on
            odd = [f"{type(exc).__name__}: {str(exc)[:1500]}"]
        took = time.time() - start
        bad += bool(odd) and name in sqls
        print(f"{'ok ' if not odd else 'BAD'} {name} {took:.1f}s {' | '.join(odd)[:1800]}", flush=True)
    print(f"{len(names)} queries, {bad} differ")


if __name__ == "__main__":
    main()
