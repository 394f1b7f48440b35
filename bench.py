"""Seconds of each headline query, warm, as one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = ["gene_counts", "base_call", "weighted_rescue", "rule_report", "mapping_rates", "expression_matrix", "validate_spearman", "gaussian", "hist_match_inter", "erode", "global_shift", "block_flow", "warp", "local_max", "components", "box_sum", "intensity_table", "crosstalk"]


def main() -> None:
    cpus, sf_dir = os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from glimmer.plans.queries import QUERIES

    took = {}
    for k, name in enumerate(["gene_counts", *HEADLINE]):
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        if k:
            took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rpartition("sf")[2]}))
    spark.stop()


if __name__ == "__main__":
    main()
