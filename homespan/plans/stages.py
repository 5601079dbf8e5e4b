"""The batch stages: ingest, enrich, features, train, recommend, cluster."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from homespan.functions import values as V
from homespan.operators import classify, cluster, neighbourhood, projections, recommend, sampling, stats
from homespan.sources import models
from homespan.sources.tables import ingest, read_table, write_table

ORDER = ["ingest", "enrich", "features", "train", "recommend", "cluster"]


class Stages:
    """Runs stages over a folder of stage tables; each stage reads what the one before has written."""

    def __init__(self, spark: SparkSession, folder: str, source: Callable[[], DataFrame], mode: str = "tables"):
        self.spark, self.folder, self.mode = spark, folder.rstrip("/"), mode
        self.sources = {mode: source}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name))

    def run(self, step: str, force: bool = False, tune: bool = True, names: Sequence[str] | None = None,
            params: dict | None = None, clusters: int = 8, restarts: int = 10) -> dict[str, float]:
        """Run one stage, or ``all``; returns seconds per stage."""
        if step != "all" and step not in ORDER:
            raise ValueError(f"unknown stage {step!r}")
        work = {
            "ingest": lambda: ingest(self.spark, self.path("raw/properties"), self.sources, self.mode, force),
            "enrich": self.enrich, "features": self.features,
            "train": lambda: self.train(names, tune, params), "recommend": self.recommend,
            "cluster": lambda: self.cluster(clusters, restarts)}
        seconds = {}
        for name in ORDER if step == "all" else [step]:
            start = time.perf_counter()
            work[name]()
            seconds[name] = round(time.perf_counter() - start, 3)
        return seconds

    def enrich(self) -> None:
        write_table(neighbourhood.enrich(self.table("raw/properties")), self.path("interim/properties_enriched"))

    def features(self) -> None:
        rows = neighbourhood.label(projections.engineer_features(self.table("interim/properties_enriched")))
        write_table(rows, self.path("processed/properties_features"))

    def train(self, names: Sequence[str] | None = None, tune: bool = True, params: dict | None = None) -> DataFrame:
        return classify.train_all(self.table("processed/properties_features"),
                                  names or ["knn", "cart", "random_forest", "boosted"], tune,
                                  self.path("models"), params)[0]

    def recommend(self, per_profile: int = 15) -> None:
        """Content model, deterministic buyer-profile ratings, and their means."""
        rows = self.table("processed/properties_features")
        models.save_model(recommend.fit_content(rows), self.path("models/recommender_content"))
        affinity = recommend.profile_affinity(rows)
        best = recommend.top_affinity(affinity, per_profile)
        browsed = sampling.top_k(affinity, ["buyer_profile"], [F.md5(F.concat("buyer_profile", "property_id"))], per_profile)
        chosen = stats.merge_candidates(best, browsed, 2 * per_profile)
        ratings = chosen.join(affinity, ["buyer_profile", "property_id"]).select(
            F.col("buyer_profile").alias("buyer_id"), "property_id", "rating", "buyer_profile")
        write_table(ratings, self.path("processed/interactions"))
        models.save_model(stats.rating_means(self.table("processed/interactions")), self.path("models/recommender_collab"))

    def cluster(self, k: int = 8, restarts: int = 10) -> None:
        rows = self.table("processed/properties_features")
        model = cluster.fit_kmeans(rows, V.CLUSTER_FEATURES, k, restarts)
        models.save_model(model, self.path("models/clustering_kmeans"))
        assigned = cluster.assign_clusters(rows, model)
        names = cluster.name_clusters(cluster.cluster_profiles(assigned)).select("cluster", "cluster_name")
        # k rows by construction
        write_table(assigned.join(F.broadcast(names), "cluster", "left"), self.path("processed/properties_clustered"))
