"""Times the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from millrace import checks  # noqa: E402
from millrace.session import local_session  # noqa: E402

QUERIES = [
    "parse_events_json", "route_user_log_counts", "cdc_classify", "dim_upsert_latest", "clean_city", "clean_song_dim",
    "dws_song_play_wide", "dws_order_wide", "geo_nearest", "dm_song_hot", "dm_login_loc", "dm_order_revenue",
    "revenue_by_region", "rollup_song_daily", "count_window_full", "count_window_keyed", "late_data_drop",
    "count_window_apply", "stream_song_hot", "stream_dim_upsert", "stream_count_window",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    checks.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, partitions=cpus)
    times = {}
    for name in QUERIES:
        run(spark, name, sf_dir)  # warm-up
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
