"""Inputs that queries derive from the given tables: zips, landed payloads, snapshots.

Nothing here is made up on its own: each input grows with the tables it comes from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from homespan.functions import values as V
from homespan.plans.base import Workspace
from homespan.session import fresh_path
from homespan.sources import landed

VALID_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def local_sales(ws: Workspace) -> DataFrame:
    """Sales with a zip code (some blank, short or zero) and a city borough (some unknown)."""
    key = F.col("buyer_key")
    place = key % 6
    borough = F.lit("elsewhere")
    for i, name in enumerate(V.BOROUGHS):
        borough = F.when(place == i, F.lit(name)).otherwise(borough)
    zipped = F.when(key % 29 == 0, F.lit(None).cast("string")).when(key % 31 == 0, F.lit("0")) \
        .when(key % 37 == 0, F.lit(" 7030 ")).otherwise((10001 + key % 173).cast("string"))
    return ws.properties().withColumns({"zip_code": zipped, "borough": borough})


def complaints(ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """(current, historic) landed complaint records, from the events."""
    rows = ws.table("events").select(
        (1 + F.col("user_id") % 34).cast("string").alias("addr_pct_cd"),
        F.col("ts").cast("string").alias("cmplnt_dt"), "event_type")
    out = []
    for name, keep in (("current", F.col("event_type") == "purchase"), ("historic", F.lit(True))):
        path = fresh_path(ws.spark, f"complaints-{name}")
        rows.filter(keep).drop("event_type").write.json(path)
        out.append(landed.read_complaints(ws.spark, path))
    return out[0], out[1]


def complaint_counts(ws: Workspace) -> DataFrame:
    return landed.read_complaint_counts(*complaints(ws))


def schools(ws: Workspace) -> DataFrame:
    """Landed school directory, from the suppliers."""
    path = fresh_path(ws.spark, "schools")
    key = F.col("s_suppkey")
    ws.table("supplier").select(
        F.col("s_name").alias("dbn"),
        F.when(key % 17 == 0, F.lit("00000")).otherwise((10001 + (key * key) % 60).cast("string")).alias("zip")) \
        .write.json(path)
    return landed.read_school_directory(ws.spark, path)


def census(ws: Workspace) -> DataFrame:
    """Array-of-arrays census payloads per zip, from the customers."""
    zips = ws.table("customer").groupBy((10001 + F.col("c_custkey") % 150).alias("z")).agg(
        F.sum("c_custkey").alias("s"), F.count(F.lit(1)).alias("n"))
    income = F.when(F.col("z") % 7 == 0, -666666666).otherwise(20000 + (F.col("s") * 37) % 100000)
    people = F.when(F.col("z") % 11 == 0, -1).otherwise(F.col("n") * 500)
    payload = F.to_json(F.array(
        F.array(F.lit("B19013_001E"), F.lit("B01003_001E"), F.lit("zip code tabulation area")),
        F.array(income.cast("string"), people.cast("string"), F.col("z").cast("string"))))
    return landed.read_census(zips.select(F.col("z").cast("string").alias("zip"), payload.alias("payload")))


def walk_scores(ws: Workspace) -> DataFrame:
    """Nested walk-score payloads per map cell, from the customers."""
    key = F.col("c_custkey")
    cells = ws.table("customer").groupBy(
        ((4040 + key % 50).cast("double") / 100).alias("lat"),
        ((-7430 + F.floor(key / 50) % 60).cast("double") / 100).alias("lng")).agg(F.min("c_custkey").alias("c"))
    c = F.col("c")
    payload = F.to_json(F.struct(
        (1 + c % 3).cast("int").alias("status"), ((c * 29) % 80).cast("double").alias("walkscore"),
        F.struct(((c * 23) % 90).cast("double").alias("score")).alias("transit"),
        F.struct(F.when(c % 5 == 0, F.lit(None)).otherwise(((c * 31) % 100).cast("double")).alias("score")).alias("bike")))
    return landed.read_walk_scores(cells.select("lat", "lng", payload.alias("payload")))


def landed_sales(ws: Workspace) -> str:
    """Path of landed sales pages (all-text JSON records), from the properties."""
    path = fresh_path(ws.spark, "sales")
    key = F.col("buyer_key")
    ws.properties().select(
        F.when(key % 6 == 5, F.lit("9")).otherwise((1 + key % 6).cast("string")).alias("borough"),
        F.col("borough").alias("neighborhood"),
        F.col("building_class").alias("building_class_category"),
        F.col("property_id").alias("address"), (10001 + key % 173).cast("string").alias("zip_code"),
        F.col("num_units").cast("string").alias("total_units"),
        F.when(F.col("item_key") % 13 == 0, F.lit(" - ")).otherwise(F.col("lot_sqft").cast("string")).alias("land_square_feet"),
        F.when(F.col("item_key") % 11 == 0, F.lit("0")).otherwise(F.col("sqft").cast("string")).alias("gross_square_feet"),
        F.when(F.col("item_key") % 17 == 0, F.lit("unknown")).otherwise(F.col("year_built").cast("string")).alias("year_built"),
        F.col("price").cast("string").alias("sale_price"),
        F.when(F.col("item_key") % 19 == 0, F.lit("n/a"))
         .otherwise(F.date_format("sale_date", "yyyy-MM-dd'T'HH:mm:ss")).alias("sale_date")) \
        .write.option("compression", "gzip").json(path)  # text records are many times their packed size
    return path


def snapshots(ws: Workspace) -> DataFrame:
    """Events as hourly fetched snapshots."""
    return ws.table("events").withColumn("fetched_at", F.date_trunc("hour", "ts").cast("timestamp_ntz"))


def judged(ws: Workspace) -> DataFrame:
    """Labels with a deterministic prediction and class scores from the price percentile."""
    p = F.col("ppsf_neighborhood_percentile")
    return ws.judged().select(
        "property_id", F.col("valuation_label").alias("actual"),
        F.when(p < 0.2, 0).when(p > 0.8, 2).otherwise(1).alias("predicted"), p.alias("p"))


def judged_scores() -> dict:
    """Class -> score expression over ``judged``."""
    p = F.col("p")
    return {0: 1.0 - p, 1: 1.0 - F.abs(2.0 * p - 1.0), 2: p}


def seeds(ws: Workspace) -> DataFrame:
    """The dearest property of each borough (five requests)."""
    best = ws.features().groupBy("borough").agg(
        F.max_by("property_id", F.struct("price", "property_id")).alias("property_id")).select("property_id")
    return ws.features().join(F.broadcast(best), "property_id", "left_semi")


def active_buyers(ws: Workspace, n: int = 3) -> DataFrame:
    """The buyers with most ratings."""
    return ws.interactions().groupBy("buyer_id").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "buyer_id").limit(n).select("buyer_id")


WISHES = {
    "family": {"budget_max": 60000, "borough": "asia", "prefer_school": True, "prefer_safe": True},
    "commuter": {"budget_max": 40000, "bedrooms_min": 3, "prefer_transit": True, "prefer_walkable": True},
    "bargain": {"borough": "EUROPE", "prefer_undervalued": True, "prefer_school": True},
}

CENTROIDS = [  # over lat, lng, income, crime, walk, transit, school
    [40.45, -74.2, 60000, 10, 30, 40, 3], [40.55, -74.1, 90000, 20, 50, 50, 5],
    [40.65, -74.0, 120000, 30, 70, 60, 7], [40.75, -73.9, 180000, 40, 90, 80, 9],
    [40.85, -73.8, 260000, 50, 60, 70, 6],
]


def clustered(ws: Workspace) -> DataFrame:
    """Rows with their nearest given centroid as cluster."""
    from homespan.operators.cluster import nearest_centroid
    return nearest_centroid(ws.features(), V.CLUSTER_FEATURES, CENTROIDS, [40.65, -74.0, 150000, 30, 60, 50, 5])
