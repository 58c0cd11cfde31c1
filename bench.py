"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from cellcast.session import local_session
from checks import registry, views

HEADLINE = ["model_table", "cell_day_table", "hotspot_kde", "best_f1_threshold", "evaluate_models", "roc_points",
            "quantile_band", "day_histogram", "arima_grid_forecast"]


def seconds(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "cellcast-bench")
    # Inputs at rest; afterwards each query is timed twice and the faster run counts.
    start = time.perf_counter()
    for name in ("incidents", "weather", "model", "centroids", "scored"):
        views.kept(spark, sf_dir, name)
    staging = time.perf_counter() - start
    times = {}
    for name in HEADLINE:
        runs = [seconds(lambda: registry.QUERIES[name](spark, sf_dir)) for _ in range(1 if name.startswith("arima") else 2)]
        times[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "total of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "staging": round(staging, 3), "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
