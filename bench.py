"""Times the headline queries and prints one JSON line.

Each query runs to completion into a sink that discards the rows, so every
column of every row is computed and nothing passes through the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES  # noqa: E402
from snapledger.session import SETTINGS  # noqa: E402

HEADLINE = [
    "hierarchy_flatten_current",
    "hierarchy_flatten_snapshots",
    "hierarchy_flatten_recent",
    "story_history_enriched",
    "agile_rollup_snapshots",
    "sprint_range",
    "current_sprint",
    "latest_per_key",
    "snapshot_merge",
    "history_store_merge",
    "history_store_refresh",
    "snapshot_gap_fill",
    "fallback_lookup",
    "null_safe_lookup",
    "agile_join_snapshots",
    "release_range",
    "table_profile",
    "table_profile_stories",
    "adhoc_sql",
    "stories_table",
    "epics_table",
    "epics_release_range",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config(map=SETTINGS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small query first, so the figures leave out the start of the session.
    QUERIES["table_count"](spark, sf_dir).collect()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
