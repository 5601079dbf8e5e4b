"""Time the headline queries: BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]; prints one JSON line.

Every query is timed on its own, result rows discarded. Stages that queries share
(property table, labels, percentiles) are timed as queries of their own.
"""

from __future__ import annotations

import json
import os
import sys
import time

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "neighborhood_percentiles", "peer_zscore", "neighborhood_profile", "market_summary", "live_market_summary",
    "label_distribution", "borough_medians", "price_trend", "describe_table", "correlation_matrix", "histogram",
    "boxplot_stats", "validate_properties", "enrich_hyperlocal", "walk_score_lookup", "canonicalize_sales",
    "recent_sales", "stratified_split", "classifier_metrics", "roc_auc_ovr", "content_features", "recommend_similar",
    "recommend_from_preferences", "profile_affinity", "recommend_for_buyer", "recommend_hybrid", "recommender_metrics",
    "heatmap_weights", "assign_clusters", "cluster_profiles", "silhouette", "classify_knn", "classify_cart",
    "classify_random_forest", "fit_kmeans", "stream_market_window", "knn_model_stored", "knn_approx",
]


def main() -> None:
    from homespan.plans.base import Workspace
    from homespan.plans.catalog import QUERIES
    from homespan.session import local_session

    spark = local_session(CPUS, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    ws = Workspace(spark, FOLDER)
    spark.range(1000).groupBy().count().collect()  # start the executors before the clock
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)

    for stage in ("properties", "enriched", "features", "model_table", "interactions"):
        timed(f"stage_{stage}", getattr(ws, stage))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, FOLDER))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
