"""Wall-clock of the headline queries: prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local threads. Every query runs once to warm up and then twice, timed,
into a sink that reads all rows and columns and keeps none; the better time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.catalog import QUERIES  # noqa: E402
from onblock.runtime import session  # noqa: E402
from onblock.sources.testdata import Tables  # noqa: E402

HEADLINE = [
    "dayof_features",
    "prev_leg_delay",
    "congestion",
    "airport_state",
    "airport_state_selfjoin",
    "weather_imputed",
    "route_table",
    "airport_profile",
    "rate_by_hour",
    "corr_matrix",
    "delay_describe",
    "target_encoding",
    "target_encoding_crossfit",
    "auc",
    "calibration",
    "hash_sample",
    "performance_report",
    "scoreboard_windows",
    "active_profile",
    "request_weather",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
    }
    spark = session("bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(3):
            tables = Tables(spark, folder)
            started = time.perf_counter()
            QUERIES[name](tables).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(min(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
