"""Time the headline queries; prints one JSON line."""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from parallaxis.plans import catalog

HEADLINE = ["covisible_pairs", "components_at_t", "near_miss_pairs", "bridge_knn", "observation_profile", "error_stats", "registration_by_clip", "window_select_override", "points_in_boxes", "box_selection", "subset_features_nulled", "validate_fk", "majority_vote", "dbscan_labels"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(1 + int(os.environ.get("BENCH_RUNS", "2"))):  # the first warms up
            began = time.time()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir}))


if __name__ == "__main__":
    main()
