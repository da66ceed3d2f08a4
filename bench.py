"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_RUNS (default 3, the median of the runs after one warm-up) set the run. A query whose
first run takes over a minute runs once: it is that run, the training of its model included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hourgrid.queries import queries  # noqa: E402
from hourgrid.session import build_session  # noqa: E402

HEADLINE = [
    "clean_trips",
    "dedupe_first",
    "trip_features",
    "zone_hour_demand",
    "zone_hour_filled",
    "demand_features",
    "model_comparison",
    "prediction_truth_join",
    "profile_numeric",
    "upsert",
    "recursive_forecast_expr",
    "recursive_forecast_boosted",
]


ONCE_ABOVE = 60


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = queries(), {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
            if times[0] > ONCE_ABOVE:
                break
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
