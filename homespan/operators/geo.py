"""Tables behind the maps, and coordinates for rows that have none."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from homespan.functions import values as V
from homespan.functions.scalar import clip, hash_exponential, hash_uniform, round_even
from homespan.operators.sampling import sample_n
from homespan.operators.skew import HOT_ROWS, group_quantiles, join_lookup
from homespan.session import cut

HEAT_METRICS = ["price_per_sqft", "crime_rate_per_1k", "walk_score", "undervalued"]


def heatmap_weights(df: DataFrame, metric: str = "price_per_sqft", sample_size: int = 8000,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """Weighted points: position between the 2nd and 98th percentile of the sample."""
    if metric not in HEAT_METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    column = "valuation_label_name" if metric == "undervalued" else metric
    points = sample_n(df.select("property_id", "lat", "lng", column).dropna(), sample_size)
    if metric == "undervalued":
        return points.filter(F.col(column) == "undervalued").select(
            "property_id", "lat", "lng", F.lit(1.0).alias("weight"))
    x = F.col(column).cast("double")
    row = group_quantiles(points, [], [column], (0.0, 0.02, 0.98, 1.0), hot_rows=hot_rows).first()  # four numbers
    least, low, high, most = row[column] if row else (None,) * 4
    lo, hi = (F.lit(v).cast("double") for v in ((least, most) if row and high - low < 1e-6 else (low, high)))
    return points.select("property_id", "lat", "lng", round_even(
        clip(F.try_divide(x - lo, hi - lo), 0.0, 1.0), 6).alias("weight"))


def map_points(df: DataFrame, kind: str = "valuation", sample_size: int = 5000) -> DataFrame:
    """Sampled points with their colour key: the cluster (missing -> 0) or the label."""
    key = (F.coalesce(F.col("cluster"), F.lit(0)).cast("string") if kind == "cluster"
           else F.col("valuation_label_name"))
    return sample_n(df, sample_size).select("property_id", "lat", "lng", "price", "price_per_sqft",
                                            key.alias("colour_key"))


def recommendation_points(catalogue: DataFrame, recommended: DataFrame) -> DataFrame:
    """Seed rows (rank 0) and their ranked results with coordinates."""
    columns = ["property_id", "lat", "lng", "price", "borough"]
    recommended = cut(recommended)
    results = join_lookup(catalogue.select(*columns), recommended.select("seed_id", "rank", "property_id"),
                          ["property_id"], "inner").select("seed_id", "rank", *columns)
    asked = recommended.select(F.col("seed_id").alias("property_id")).distinct()
    seeds = join_lookup(catalogue.select(*columns), asked, ["property_id"], "left_semi")
    return seeds.select(F.col("property_id").alias("seed_id"), F.lit(0).alias("rank"), *columns).unionByName(results)


def impute_coordinates(df: DataFrame, key: str = "property_id") -> DataFrame:
    """A repeatable point in the borough's box, if no row of the table has a latitude."""
    boxes = F.broadcast(V.borough_profiles(df.sparkSession).select(  # five rows
        F.col("borough").alias("__b"), "lat_lo", "lat_hi", "lng_lo", "lng_hi"))
    known = F.upper(F.coalesce("borough", F.lit(V.DEFAULT_BOROUGH)))
    placed = df.withColumn("__k", F.when(known.isin(V.BOROUGHS), known).otherwise(V.DEFAULT_BOROUGH)) \
        .join(boxes, F.col("__k") == F.col("__b"))
    draw = {c: F.col(f"{c}_lo") + (F.col(f"{c}_hi") - F.col(f"{c}_lo")) * hash_uniform(key, c) for c in ("lat", "lng")}
    if "lat" in df.columns:
        given = df.agg(F.count("lat").alias("n")).scalar()
        old = {c: F.col(c) if c in df.columns else F.lit(None).cast("double") for c in ("lat", "lng")}
        draw = {c: F.when(given == 0, draw[c]).otherwise(old[c]) for c in draw}
        flag = given == 0
    else:
        flag = F.lit(True)
    return placed.withColumns({**draw, "coordinates_imputed": flag}).drop(
        "__k", "__b", "lat_lo", "lat_hi", "lng_lo", "lng_hi")


def impute_distances(df: DataFrame, key: str = "property_id") -> DataFrame:
    """Repeatable distances (exponential, clipped) and flood flag (8 in 100)."""
    return df.withColumns({
        "nearest_subway_m": clip(hash_exponential(key, "subway", 400.0), 50.0, 5000.0).cast("int"),
        "nearest_park_m": clip(hash_exponential(key, "park", 600.0), 50.0, 4000.0).cast("int"),
        "flood_zone_flag": (hash_uniform(key, "flood") >= 0.92).cast("int"),
    })
