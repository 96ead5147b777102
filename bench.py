"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads.
Each query runs twice to warm up and then three times into the ``noop`` sink;
its time is the median. ``comparison`` times three formulations of
``mask_outliers_by_user``, on the events as they are and with ten times the
users; it is not part of the total.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.forms import join_form, profile_form, user_readings, window_form  # noqa: E402
from checks.queries import all_queries  # noqa: E402

HEADLINE = [
    "daily_summary",
    "daily_summary_by_user",
    "mask_outliers",
    "mask_outliers_by_user",
    "impute_gaps_by_user",
    "anomalies_by_user",
    "gap_expand_by_user",
    "missing_slots_by_user",
    "hourly_baseline_by_user",
    "expected_grid_by_user",
    "null_audit_by_user",
    "readings_hourly_by_user",
    "range_scan",
    "upsert_daily_by_user",
    "upsert_cleaned_by_user",
]
WARM_UP = 2
RUNS = 3


def once(make: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_seconds(make: Callable[[], DataFrame], warm_up: int = WARM_UP, runs: int = RUNS) -> float:
    for _ in range(warm_up):
        once(make)
    return round(statistics.median(once(make) for _ in range(runs)), 3)


def compare(spark: SparkSession, sf_dir: str, copies: int, warm_up: int, runs: int) -> dict[str, float]:
    return {
        form.__name__: median_seconds(lambda form=form: form(*user_readings(spark, sf_dir, copies)), warm_up, runs)
        for form in (profile_form, join_form, window_form)
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("slotwise-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    times = {name: median_seconds(lambda name=name: queries[name](spark, sf_dir)) for name in HEADLINE}
    comparison = {
        "users_x1": compare(spark, sf_dir, 1, WARM_UP, RUNS),
        "users_x10": compare(spark, sf_dir, 10, 1, 2),
    }
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "comparison": comparison,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
