"""Run registered queries against their SQL statements: python tests/check_queries.py DIR [name...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tradewharf.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "check", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        }
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sql:
                text = compare(df, con, sql[name])
            else:
                text = f"no SQL, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            text = f"{type(e).__name__}: {str(e)[:500]}"
        if text and not text.startswith("no SQL"):
            bad += 1
        print(f"{name:48s} {time.time() - start:6.2f}  {text or 'ok'}", flush=True)
    print("failed:", bad)
    print("without query:", sorted(set(sql) - set(queries)))


main()
