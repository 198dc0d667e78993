"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query runs twice to warm up; the median of the runs after that is reported. Results go to the
`noop` sink; a streaming query is timed from its start to the reading of its sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riverglass import build_session  # noqa: E402
from riverglass.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "rating_top10", "hot_keywords_top10", "hot_segments_top10", "user_hot_terms_top10",
    "user_top_terms", "search_heat_by_hour", "tumbling_counts", "sliding_top3",
    "sliding_counts_by_panes", "signal_over_30", "device_stats", "distinct_devices_by_type",
    "answer_stats", "error_prone_top", "learning_report", "tumbling_counts_stream",
    "sliding_top3_stream", "device_stats_stream", "station_etl", "als_user_recs", "live_recs",
]

WARM_UPS = 2


def once(spark, sf_dir: str, name: str) -> float:
    begun = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="16g", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        for _ in range(WARM_UPS):
            once(spark, sf_dir, name)
        seconds[name] = round(statistics.median(once(spark, sf_dir, name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds_of_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
        "spark": spark.version,
        "shuffle_partitions": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
