"""Headline queries on one machine: prints one JSON line with seconds per query.

BENCH_SF_DIR: folder of the tables (default sf0.1). BENCH_CPUS: local cores. BENCH_QUERIES: names,
comma-separated, in place of the headline list.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "community_metrics", "rotation_abundance", "aggregate_metric", "species_diversity", "parametric_diversity", "grid_indicators",
    "rarefaction", "lcbd", "bray_curtis", "dissimilarity_summary", "describe_by", "turned_block_score", "indicator_values",
    "tidy_detections", "recording_time", "rare_species_flags", "merge_complementary", "nearest_point", "nearest_in_time", "enrich_with_grid",
    "pairs_within", "extrapolate_ids", "validation_effort", "site_summary", "day_grid", "abundance_index", "autocorrelation",
    "annual_variation_by_species", "overall_trend", "glm_poisson", "levene", "idw", "variant_filter_chain", "basic_stats_by_locus",
    "pairwise_fst", "position_counts", "tree_closure", "phylo_diversity", "spectral_indices", "moving_diversity", "land_cover_transition",
    "select_at_points", "lcbd_permutation",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from biolattice.plans import all_queries

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g")).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    qs = all_queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n in qs]
    spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    took = {}
    for n in names:
        t = time.perf_counter()
        qs[n](spark, sf).write.format("noop").mode("overwrite").save()
        took[n] = round(time.perf_counter() - t, 3)
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
