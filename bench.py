"""Time the headline queries, each after one warm-up run; prints one JSON line.

BENCH_SF_DIR  folder with the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

import registry
from arealis.session import local_session

HEADLINE = [
    "count_by_loc_month", "densify_grid", "temporal_features", "revictimization_risk", "feature_table",
    "neighbor_features", "knn_edges_divided", "nearest_station", "population_join", "snapshot_join",
    "collect_events", "dedup_events", "describe_table", "allocate_daily", "allocate_hourly_remainder",
    "nest_points", "integrate_all", "regression_metrics", "forecast_months", "ols_hc3", "lowess",
    "train_poisson", "train_forest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in HEADLINE:
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
