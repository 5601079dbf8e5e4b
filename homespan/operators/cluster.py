"""Area clusters: k-means, its evaluation, profiles and names, and a hierarchy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from homespan.functions import values as V
from homespan.functions.scalar import round_even
from homespan.operators.sampling import sample_n
from homespan.operators.skew import HOT_ROWS, group_medians
from homespan.session import fresh_path, short_scans

SILHOUETTE_ROWS = 5000
EXACT_SAMPLE_LIMIT = 20_000  # rows a task may hold for the exact silhouette


def _vector_steps(features: Sequence[str]) -> list:
    filled = [f"__i_{c}" for c in features]
    return [Imputer(strategy="median", relativeError=0.0001, inputCols=list(features), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="__raw"),
            StandardScaler(inputCol="__raw", outputCol="scaled", withMean=True, withStd=True)]


def _as_double(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in features})


def vectors(df: DataFrame, features: Sequence[str] = tuple(V.CLUSTER_FEATURES),
            keep: Sequence[str] = ()) -> tuple[DataFrame, PipelineModel]:
    """The kept columns and the standardised vector ``scaled`` of every row, stored once for the many passes that follow."""
    usable = [c for c in features if c in df.columns]
    rows = _as_double(df, usable)
    model = Pipeline(stages=_vector_steps(usable)).fit(rows)
    path = fresh_path(df.sparkSession, "vectors")
    model.transform(rows).select(*keep, "scaled").write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path), model


def fit_kmeans(df: DataFrame, features: Sequence[str] = tuple(V.CLUSTER_FEATURES), k: int = 8, restarts: int = 10,
               max_iter: int = 300, seed: int = 42) -> PipelineModel:
    """Best of several k-means runs as one pipeline with the imputation and scaling."""
    data, prepared = vectors(df, features)
    best = None
    with short_scans(df.sparkSession):  # each fit keeps the decoded vectors itself, ready for all its passes
        for i in range(restarts):
            model = KMeans(featuresCol="scaled", predictionCol="cluster", k=k, seed=seed + i, maxIter=max_iter,
                           initMode="k-means||").fit(data)
            if best is None or model.summary.trainingCost < best.summary.trainingCost:
                best = model
    return PipelineModel(stages=[*prepared.stages, best])


def assign_clusters(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``cluster``; missing inputs take the training medians held by the model."""
    inputs = model.stages[0].getInputCols()
    typed = df.withColumns({c: F.col(c).cast("double") for c in inputs})
    return model.transform(typed).select(*[df[c] if c not in inputs else F.col(c) for c in df.columns], "cluster")


def nearest_centroid(df: DataFrame, features: Sequence[str], centroids: Sequence[Sequence[float]],
                     medians: Sequence[float]) -> DataFrame:
    """Assignment to given centroids as one expression; ties go to the lower number."""
    x = [F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in zip(features, medians)]

    def distance(centre: Sequence[float]) -> Column:
        total = F.lit(0.0)
        for xi, ci in zip(x, centre):
            total = total + (xi - F.lit(float(ci))) * (xi - F.lit(float(ci)))
        return round_even(total, 6)
    options = [F.struct(distance(c).alias("d"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]
    best = F.least(*options)
    return df.withColumns({"cluster": best.getField("cluster"), "distance2": best.getField("d")})


def elbow_scan(df: DataFrame, features: Sequence[str] = tuple(V.CLUSTER_FEATURES), ks: Sequence[int] = range(3, 13),
               rows: int | None = None, restarts: int = 5, max_iter: int = 300, seed: int = 42) -> DataFrame:
    """(k, inertia, Euclidean silhouette of a fixed-size sample) of fits to all rows, or to a sample of ``rows``."""
    data, _ = vectors(sample_n(df, rows) if rows else df, features, ["property_id"])
    out = []
    for k in ks:
        with short_scans(df.sparkSession):
            best = min((KMeans(featuresCol="scaled", predictionCol="cluster", k=k, seed=seed + i, maxIter=max_iter).fit(data)
                        for i in range(restarts)), key=lambda m: m.summary.trainingCost)
        judged = best.transform(data).select("property_id", vector_to_array("scaled").alias("features"), "cluster")
        out.append((k, float(best.summary.trainingCost), float(silhouette(judged).first().silhouette)))
    return df.sparkSession.createDataFrame(out, "k int, inertia double, silhouette double")


def silhouette(df: DataFrame, vector: str = "features", label: str = "cluster", rows: int = SILHOUETTE_ROWS,
               key: str = "property_id") -> DataFrame:
    """Mean Euclidean silhouette over a fixed-size sample (one row).

    The sample (at most ``EXACT_SAMPLE_LIMIT`` rows) is shipped to the tasks,
    each of which measures its own share of the points against it.
    """
    if rows > EXACT_SAMPLE_LIMIT:
        raise ValueError(f"at most {EXACT_SAMPLE_LIMIT} rows; use ClusteringEvaluator for more")
    spark = df.sparkSession
    sample = sample_n(df.select(key, vector, label), rows, key)
    local = sample.toPandas()
    points = np.stack(local[vector].to_numpy()).astype(float)
    codes, names = pd.factorize(local[label])
    shared = spark.sparkContext.broadcast((points, codes, len(names), {k: i for i, k in enumerate(local[key])}))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, code, n, place = shared.value
        member = np.eye(n)[code]
        sizes = member.sum(axis=0)
        for pdf in batches:
            if pdf.empty:
                continue
            at = np.array([place[k] for k in pdf[key]])
            x = base[at]
            d = np.sqrt(np.maximum((x**2).sum(1)[:, None] - 2 * x @ base.T + (base**2).sum(1)[None, :], 0))
            d[np.arange(len(at)), at] = 0.0
            sums = d @ member
            own = code[at]
            row = np.arange(len(at))
            inner = sums[row, own] / np.maximum(sizes[own] - 1, 1)
            means = sums / sizes
            means[row, own] = np.inf
            outer = means.min(axis=1)
            s = np.where(sizes[own] > 1, (outer - inner) / np.maximum(np.maximum(outer, inner), 1e-300), 0.0)
            yield pd.DataFrame({"s": s})
    ids = spark.createDataFrame(local[[key]]).repartition(spark.sparkContext.defaultParallelism)
    return ids.mapInPandas(score, "s double").agg(
        F.count(F.lit(1)).alias("n"), round_even(F.avg("s"), 6).alias("silhouette"))


def cluster_profiles(df: DataFrame, cluster: str = "cluster", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Eight medians (two decimals) and the size per cluster."""
    columns = [c for c in V.CLUSTER_PROFILE_COLUMNS if c in df.columns]
    out = group_medians(df, [cluster], columns, [F.count(F.lit(1)).alias("n_properties")], hot_rows)
    return out.withColumns({c: round_even(c, 2) for c in columns})


def name_clusters(profiles: DataFrame) -> DataFrame:
    """Readable name from a cluster's medians; a missing metric counts as ordinary."""
    def metric(name: str, ordinary: float) -> Column:
        return F.coalesce(F.col(name), F.lit(ordinary)) if name in profiles.columns else F.lit(ordinary)
    price, walk = metric("price_per_sqft", 0.0), metric("walk_score", 50.0)
    crime, school = metric("crime_rate_per_1k", 25.0), metric("school_quality_score", 5.0)
    return profiles.withColumn("cluster_name", F.concat_ws(
        "_",
        F.when(price > 1200, "Luxury").when(price > 700, "MidTier").otherwise("Affordable"),
        F.when(walk > 85, "HighlyWalkable").when(walk < 60, "CarOriented"),
        F.when(crime < 15, "LowCrime").when(crime > 35, "HighCrime"),
        F.when(school > 7, "TopSchools")))


def hierarchical_clusters(df: DataFrame, features: Sequence[str] = tuple(V.CLUSTER_FEATURES), k: int = 8,
                          seed: int = 42) -> PipelineModel:
    """Top-down hierarchy (bisecting k-means) over all rows, no sampling."""
    data, prepared = vectors(df, features)
    with short_scans(df.sparkSession):
        model = BisectingKMeans(featuresCol="scaled", predictionCol="cluster", k=k, seed=seed).fit(data)
    return PipelineModel(stages=[*prepared.stages, model])
