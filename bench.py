"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from emberfield.plans import catalogue
from emberfield.session import get_session

HEADLINE = [
    "incidents_with_hubs", "align_observation", "build_location_registry", "fire_event_full_v2", "unify_fires", "estimate_extinguish",
    "grid_pass_agg", "burning_neighbors", "cell_lag_lead", "gridded_satellite_table", "env_12h_mean", "label_spine_left",
    "merge_one_to_one", "nearest_grid_point", "nearest_registry_windowed", "link_fire_to_weather", "point_in_polygon_left",
    "fires_x_grid", "cell_fire_stats", "interpolate_time_series_forward", "last_n_sequence", "sliding_windows", "time_split_ratio",
    "negative_subsample", "fit_apply_scaler", "compute_metrics", "find_best_threshold", "narrative_cluster_objects",
    "active_incident_objects", "append_new_by_key",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session("bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue()
    queries["season"].run(spark, folder).write.format("noop").mode("overwrite").save()  # start-up is not a query
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf,
    }))


if __name__ == "__main__":
    main()
