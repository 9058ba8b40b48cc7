"""Times the headline queries and prints one JSON line. BENCH_SF_DIR: the tables (default sf0.1); BENCH_CPUS: local cores (default 8)."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from furlong.plans.catalog import QUERIES

HEADLINE = [
    "flagship_figures", "iterate_std_ga", "std_times_median", "weighted_median", "trimmed_median", "winsor_mean_se", "interp_lookup", "lag_safe_career", "rolling_prior", "harmonic_and_decay",
    "pedigree_shrunk", "hot_form_3d", "race_ranks", "expect_residual", "residual_layers", "error_grouping_sets", "quantile_map_linear", "split_card_test", "race_qc", "gbt_predict",
]


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["value_counts"](spark, sf).write.format("noop").mode("overwrite").save()  # start the executors
    took = {}
    for name in HEADLINE:
        best = []
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - began)
        took[name] = round(min(best), 3)
    print(json.dumps({"metric": "total seconds of the headline queries, best of two runs each", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
