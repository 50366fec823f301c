"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from veracast.plans import catalogue
from veracast.session import build_session

HEADLINE = [
    "creator_trust_leaderboard",
    "unified_features",
    "content_sentiment",
    "dedupe_latest",
    "mojibake",
    "stream_scores",
    "score_events",
    "latest_per_creator",
    "timeseries",
    "live_metrics",
    "overview_kpis",
    "windowed_activity",
    "comment_threads",
    "upload_frequency",
    "creator_profiles",
    "category",
    "top_creators",
    "dataset_stats",
    "scores_from_serving",
    "creator_bundles",
    "export_bundle",
    "quality_comments",
    "stream_scores_available_now",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One run of a small query loads classes and starts the workers.
    catalogue.QUERIES["event_type_mix"](spark, sf_dir).collect()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
