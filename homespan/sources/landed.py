"""Readers for landed API payloads, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from homespan.functions.values import SALES_FIELDS

SALES_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in SALES_FIELDS])
SALES_TTL_HOURS = 1
HYPERLOCAL_TTL_HOURS = 7 * 24
STALE_AFTER_DAYS = 90


def read_sales_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed sales pages: flat records whose values are all text."""
    return spark.read.schema(SALES_SCHEMA).json(path)


def read_complaints(spark: SparkSession, path: str) -> DataFrame:
    """Landed complaint records."""
    return spark.read.schema("addr_pct_cd string, cmplnt_dt timestamp_ntz").json(path)


def read_complaint_counts(current: DataFrame, historic: DataFrame, year: int | None = None) -> DataFrame:
    """Complaints per precinct from the current set, or the historic one if that has none."""
    def counted(df: DataFrame, source: str) -> DataFrame:
        rows = df.filter(F.year("cmplnt_dt") == year) if year else df
        return rows.select(F.trim("addr_pct_cd").alias("addr_pct_cd")).filter(F.col("addr_pct_cd") != "") \
            .groupBy("addr_pct_cd").agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit(source))
    first = counted(current, "current")
    found = first.agg(F.count(F.lit(1)).alias("n")).scalar()
    return first.unionByName(counted(historic, "historic").filter(found == 0))


def read_school_directory(spark: SparkSession, path: str) -> DataFrame:
    """(dbn, zip) of every school."""
    return spark.read.schema("dbn string, zip string").json(path).select("dbn", "zip")


def read_census(payloads: DataFrame) -> DataFrame:
    """Array-of-arrays payloads (``zip``, ``payload``): the first row names the columns."""
    rows = payloads.select("zip", F.from_json("payload", "array<array<string>>").alias("rows")) \
        .filter(F.size("rows") >= 2)
    named = rows.select("zip", F.map_from_arrays(F.col("rows")[0], F.col("rows")[1]).alias("m"))

    def number(name: str):
        return F.coalesce(F.try_element_at("m", F.lit(name)).try_cast("bigint"), F.lit(-1)).alias(name)
    return named.select("zip", number("B19013_001E"), number("B01003_001E"))


WALK_PAYLOAD = "status int, walkscore double, transit struct<score: double>, bike struct<score: double>"


def read_walk_scores(payloads: DataFrame) -> DataFrame:
    """Nested payloads (``lat``, ``lng``, ``payload``); only status 1 and 2 count."""
    parsed = payloads.select("lat", "lng", F.from_json("payload", WALK_PAYLOAD).alias("p"))
    return parsed.filter(F.col("p.status").isin(1, 2)).select(
        "lat", "lng", F.col("p.walkscore").alias("walk_score"),
        F.col("p.transit.score").alias("transit_score"), F.col("p.bike.score").alias("bike_score"))


def latest_fresh_snapshot(snapshots: DataFrame, now: str, ttl_hours: int = SALES_TTL_HOURS,
                          at: str = "fetched_at") -> DataFrame:
    """Rows of the newest snapshot that is no older than the time to live."""
    oldest = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(ttl_hours))
    fresh = snapshots.filter((F.col(at) >= oldest) & (F.col(at) <= F.lit(now).cast("timestamp_ntz")))
    newest = fresh.agg(F.max(at).alias("newest")).scalar()
    return fresh.filter(F.col(at) == newest)


def data_freshness(df: DataFrame, name: str, now: str, at: str = "fetched_at") -> DataFrame:
    """Name, true row count, last update, age in days and state (one row)."""
    row = df.agg(F.count(F.lit(1)).alias("row_count"), F.max(at).alias("last"))
    age = F.date_diff(F.lit(now).cast("date"), F.col("last").cast("date"))
    return row.select(F.lit(name).alias("dataset"), "row_count",
                      F.date_format("last", "yyyy-MM-dd").alias("last_update"), age.cast("bigint").alias("age_days"),
                      F.when(age < STALE_AFTER_DAYS, "fresh").otherwise("stale").alias("state"))
