"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the cores
(default 8). Each query runs once to warm up and then BENCH_RUNS times (default 3); the
fastest run counts. Results go to a sink that reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starloom.queries import QUERIES  # noqa: E402
from starloom.session import SETTINGS  # noqa: E402

HEADLINE = (
    "star_target",
    "lookup_first_match",
    "lookup_first_row_fallback",
    "lookup_within_database",
    "upsert_last_wins",
    "load_accepted",
    "load_rejects",
    "window_new_range",
    "multi_db_union",
    "sanitize_nan",
    "read_extract_multi",
    "constraint_issues",
    "job_state",
    "profile_targets",
    "target_dim_users",
    "target_fct_executions",
    "target_fct_test_results",
    "target_dim_test_cases",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in {
        **SETTINGS,
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 4)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": int(cpus),
                "shuffle_partitions": int(cpus),
                "lineitem_rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
