"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (folder of test tables), BENCH_CPUS, and optionally
BENCH_QUERIES (comma-separated names from the catalogue, or "all").
Every query runs twice and is computed in full both times (nothing is kept
between runs); "queries" has the second time, "cold" the first. "incremental_day"
is one batch alone, the last day with a twentieth of all earlier rows arriving
late, into a store that is built before the clock starts.
"""

from __future__ import annotations

import json
import os
import time
from datetime import datetime

from pulseledger import catalog
from pulseledger.plans import incremental, pipeline
from pulseledger.session import drop_scratch, local_session, scratch_path
from pulseledger.sources import testdata

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
HEADLINE = (
    "stage_tracks",
    "stage_tracks_unstitched",
    "sessions",
    "sessions_incremental",
    "dim_accounts",
    "dim_users",
    "product_trends",
    "account_health",
    "account_health_yesterday",
    "feature_usage",
    "user_snapshot",
    "churn_alerts",
)


def run_query(spark, name: str) -> None:
    catalog.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()


def run_build(spark) -> None:
    """Every relation of the metric layer, written as tables."""
    pipeline.build(testdata.TestTables(spark, SF_DIR), catalog.MAIN, scratch_path(spark, "bench"))


def prepare_day(spark) -> tuple:
    """A store of all days but the last, and the arguments of the batch to come."""
    raw = testdata.TestTables(spark, SF_DIR)
    last = "timestamp >= TIMESTAMP'2024-01-30 00:00:00'"
    late = f"({last} OR pmod(xxhash64(id), 20) = 0)"
    folder = scratch_path(spark, "store")
    first = pipeline.Inputs(raw.tracks.filter(f"NOT {late}"), None, raw.identifies.filter(f"NOT ({last})"))
    incremental.build_incremental(first, catalog.MAIN.replace(as_of=datetime(2024, 1, 30, 6)), folder, 0)
    return pipeline.Inputs(raw.tracks.filter(late), None, raw.identifies.filter(last)), catalog.MAIN, folder, 1


def main() -> None:
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = local_session(cores=CPUS, shuffle_partitions=CPUS)
    n_events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    tasks = {name: lambda name=name: run_query(spark, name) for name in names if name != "incremental_day"}
    tasks["full_build"] = lambda: run_build(spark)
    if not chosen or "incremental_day" in names:
        tasks["incremental_day"] = lambda batch: incremental.build_incremental(*batch)
    times: list[dict[str, float]] = []
    for _ in range(2):
        times.append({})
        for name, task in tasks.items():
            prepared = [prepare_day(spark)] if name == "incremental_day" else []
            start = time.perf_counter()
            task(*prepared)
            times[-1][name] = round(time.perf_counter() - start, 3)
    cold, warm = times
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "events": n_events,
                "full_build_events_per_sec": round(n_events / warm["full_build"]),
                "sessions_events_per_sec": round(n_events / warm["sessions"]) if "sessions" in warm else None,
            }
        )
    )
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
