"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the folder with the test tables, ``BENCH_CPUS`` the number of local
cores. Every query runs once to warm up and then three times, a long one once; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from partylens.session import build_session
from verification import QUERIES

HEADLINE = [
    "q01_invoice_features", "q02_wide_invoice_features", "q03_transfer_features", "q04_clean_static",
    "q06_combined_features", "q07_strict_profile", "q08_login_profile", "q13_login_reconciliation",
    "q14_static_quality", "m05_elbow_curve", "m06_sweep", "q09_profile_clusters", "q10_train_clusters",
]
RUNS = 3
LONG = 30  # seconds


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    runs = int(os.environ.get("BENCH_RUNS", RUNS))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        # A query that took long to warm up is timed once, whatever the wanted number of runs.
        again = 1 if timed(spark, name, folder) > LONG else runs
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(again)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
