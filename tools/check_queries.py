"""Run every registered query next to its DuckDB text and report differences.

usage: python tools/check_queries.py [sf_dir] [name ...]

CHECK_ZONE sets another session time zone; CHECK_PLAIN=1 leaves all other
session settings at Spark's defaults.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from hourgrid import session  # noqa: E402
from hourgrid.queries import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    settings = {
        "spark_sql_shuffle_partitions": "8",
        "spark_ui_enabled": "false",
        "spark_ui_showConsoleProgress": "false",
        "spark_sql_session_timeZone": os.environ.get("CHECK_ZONE", "UTC"),
    }
    if os.environ.get("CHECK_PLAIN"):
        session.DEFAULTS.clear()
    spark = session.build_session("check", master="local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    sql, failed = oracle_sql(), []
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            got = rows_of(df.columns, df.collect())
            spent = time.time() - started
            if name not in sql:
                print(f"rows  {name:34s} {len(got):8d} rows {spent:6.2f}s", flush=True)
                continue
            text = sql[name].replace("/root/testdata/sf0.01", sf_dir)
            cursor = duck.execute(text)
            names = [d[0] for d in cursor.description]
            expected = rows_of(names, cursor.fetchall())
            same = sorted(names) == sorted(df.columns) and got == expected
            print(f"{'same ' if same else 'DIFF '} {name:34s} {len(got):8d} rows {spent:6.2f}s", flush=True)
            if not same:
                failed.append(name)
                print("   columns", sorted(names), sorted(df.columns), "rows", len(expected), len(got))
                for pair in [(a, b) for a, b in zip(got, expected) if a != b][:3]:
                    print("   spark", pair[0], "\n   sql  ", pair[1])
        except Exception as error:  # report and go on with the next query
            failed.append(name)
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
