"""Local context by zip code, precinct and coordinates, joined onto sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from homespan.functions import values as V
from homespan.functions.scalar import clip, hash_normal, normalize_zip, round_even
from homespan.operators.skew import join_lookup, join_on
from homespan.session import cut

PROFILE_NAMES = [part.split()[0] for part in V.PROFILE_COLUMNS.split(", ")][1:]
PROFILE_FIELDS = {  # field -> (mean, deviation) of the borough profile
    "walk_score": ("walk_mean", "walk_std"), "transit_score": ("transit_mean", "transit_std"),
    "crime_rate_per_1k": ("crime_mean", "crime_std"), "school_quality_score": ("school_mean", "school_std"),
    "median_household_income": ("income_mean", "income_std"),
}


def known_borough(x: Column) -> Column:
    """Upper-case borough, or the default for anything unknown."""
    upper = F.upper(x.cast("string"))
    return F.when(upper.isin(V.BOROUGHS), upper).otherwise(F.lit(V.DEFAULT_BOROUGH))


def borough_profile_lookup(df: DataFrame, borough: str = "borough") -> DataFrame:
    """Attach the borough's profile columns (five fixed rows, broadcast)."""
    profiles = V.borough_profiles(df.sparkSession).withColumnRenamed("borough", "__profile")
    keyed = df.withColumn("__borough", known_borough(F.col(borough)))
    return keyed.join(F.broadcast(profiles), F.col("__borough") == F.col("__profile")).drop("__borough", "__profile")


def _stand_in(field: str, draw_key: str | None = None) -> Column:
    """The borough mean, or a repeatable draw around it, before it is limited."""
    if field == "bike_score":
        mean, std = F.col("walk_mean") - V.BIKE_BELOW_WALK, F.lit(V.BIKE_STD)
    elif field == "population_density":
        mean, std = F.lit(V.DENSITY_MEAN), F.lit(V.DENSITY_STD)
    else:
        mean, std = (F.col(c) for c in PROFILE_FIELDS[field])
    return mean + std * hash_normal(draw_key, field) if draw_key else mean


def fallback_value(field: str, draw_key: str | None = None) -> Column:
    """Stand-in for a missing value: the borough mean, or a repeatable draw around it.

    Needs the profile columns on the row.
    """
    return clip(_stand_in(field, draw_key), *V.FALLBACK_LIMITS[field])


def hyperlocal_fallback(df: DataFrame, draw_key: str | None = None) -> DataFrame:
    """All seven stand-in values as ``fallback_<field>``.

    A draw is a column before it is limited: ``clip`` reads its value twice, and a step per field keeps the generated
    code small enough to be compiled.
    """
    wide = borough_profile_lookup(df)
    for f, limits in V.FALLBACK_LIMITS.items():
        name = f"fallback_{f}"
        wide = wide.withColumn(name, _stand_in(f, draw_key)).withColumn(name, clip(F.col(name), *limits))
    return wide.drop(*PROFILE_NAMES)


def zip_borough(df: DataFrame) -> DataFrame:
    """Borough of a zip code: that of its first sale by id."""
    return df.withColumn("zip_code", normalize_zip("zip_code")).filter(F.col("zip_code") != "") \
        .groupBy("zip_code").agg(F.min_by("borough", "property_id").alias("zip_borough"))


def precinct_zip_bridge(spark) -> DataFrame:
    """(zip_code, precinct) pairs of the fixed precinct table."""
    return V.precinct_zips(spark).select(F.explode("zips").alias("zip_code"), "precinct")


def crime_rate_by_zip(counts: DataFrame) -> DataFrame:
    """Complaints per 1,000 people per zip, over the precincts that cover it.

    ``counts``: (addr_pct_cd, n). Only zips with a precinct appear, and none if
    there are no counts at all; other zips take the borough fallback.
    """
    clean = counts.select(F.trim("addr_pct_cd").alias("pct"), F.coalesce("n", F.lit(0)).alias("n")) \
        .filter(F.col("pct") != "").groupBy("pct").agg(F.sum("n").alias("n"))
    bridge = F.broadcast(precinct_zip_bridge(counts.sparkSession))  # about 200 fixed rows
    inside = clean.join(bridge, F.col("pct") == F.col("precinct").cast("string"))
    sums = inside.groupBy("zip_code").agg(F.sum("n").alias("complaint_count"))
    any_count = clean.agg(F.count(F.lit(1)).alias("n")).scalar()
    zips = bridge.groupBy("zip_code").agg(F.sort_array(F.collect_list("precinct")).alias("precincts"))
    out = zips.join(sums, "zip_code", "left").filter(any_count > 0)
    total = F.coalesce("complaint_count", F.lit(0))
    rate = round_even(total / F.lit(float(V.PRECINCT_POPULATION)) * 1000, 2)
    return out.select("zip_code", total.alias("complaint_count"), F.size("precincts").alias("n_precincts"),
                      clip(rate, 1.0, 80.0).alias("crime_rate_per_1k"))


def school_counts(schools: DataFrame) -> DataFrame:
    """Schools per zip; blank and 00000 left out."""
    return schools.select(normalize_zip("zip").alias("zip_code")).filter(F.col("zip_code") != "") \
        .groupBy("zip_code").agg(F.count(F.lit(1)).alias("n_schools"))


def school_score(mean: Column, n: Column) -> Column:
    """Borough mean adjusted by how many schools the zip has."""
    change = F.when(n >= 5, 1.0).when(n >= 3, 0.5).when(n >= 1, 0.0).otherwise(-1.0)
    return clip(round_even(mean + change, 2), 1.0, 10.0)


def school_score_by_zip(zips: DataFrame, schools: DataFrame) -> DataFrame:
    """Score per zip of ``zips`` (zip_code, zip_borough); no rows if the directory is empty."""
    counts = school_counts(schools)
    any_school = counts.agg(F.count(F.lit(1)).alias("n")).scalar()
    scored = borough_profile_lookup(join_on(zips, counts, ["zip_code"], "left"), "zip_borough").filter(any_school > 0)
    n = F.coalesce("n_schools", F.lit(0))
    return scored.select("zip_code", n.alias("n_schools"),
                         school_score(F.col("school_mean"), n).alias("school_quality_score"))


def census_by_zip(zips: DataFrame, census: DataFrame) -> DataFrame:
    """Income and density per zip of ``zips``; a negative income takes the borough mean."""
    facts = census.select(normalize_zip("zip").alias("zip_code"), F.col("B19013_001E").alias("income"),
                          F.col("B01003_001E").alias("people"))
    wide = borough_profile_lookup(join_on(zips, facts, ["zip_code"]), "zip_borough")
    income = F.coalesce(F.nullif("income", F.lit(0)), F.lit(-1))
    people = F.coalesce(F.nullif("people", F.lit(0)), F.lit(-1))
    return wide.select(
        "zip_code",
        F.when(income < 0, fallback_value("median_household_income")).otherwise(income).cast("bigint")
         .alias("median_household_income"),
        F.least(F.when(people < 0, 50000).otherwise(people) * V.CENSUS_DENSITY_FACTOR, F.lit(V.MAX_DENSITY))
         .cast("bigint").alias("population_density"))


def coordinate_key(lat: str, lng: str) -> Column:
    """lat and lng at four decimals, as text."""
    return F.format_string("%.4f_%.4f", F.col(lat), F.col(lng))


WALK_FIELDS = ["walk_score", "transit_score", "bike_score"]


def walk_score_lookup(df: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores at the same four-decimal coordinates; a missing or zero score falls back.

    ``scores``: lat, lng and the three scores.
    """
    keyed = scores.select(coordinate_key("lat", "lng").alias("__at"), *[
        F.col(f).alias(f"found_{f}") for f in WALK_FIELDS])
    one = keyed.groupBy("__at").agg(*[F.max(f"found_{f}").alias(f"found_{f}") for f in WALK_FIELDS])
    rows = join_lookup(df.drop(*WALK_FIELDS).withColumn("__at", coordinate_key("lat", "lng")), one, ["__at"])
    wide = borough_profile_lookup(rows)
    return wide.withColumns({
        **{f: round_even(F.coalesce(F.nullif(f"found_{f}", F.lit(0.0)), fallback_value(f)), 1) for f in WALK_FIELDS},
        "walk_source": F.when(F.col("found_walk_score").isNotNull(), "walk_scores").otherwise("borough_fallback"),
    }).drop("__at", *[f"found_{f}" for f in WALK_FIELDS], *PROFILE_NAMES)


def enrich_hyperlocal(df: DataFrame, census: DataFrame, counts: DataFrame, schools: DataFrame,
                      scores: DataFrame | None = None, draw_key: str | None = None) -> DataFrame:
    """Zip-level context on every sale, with the source of each value.

    All sources meet in one table per zip, which is counted before it is
    broadcast. A value without a source falls back to the borough of the zip, or
    to the sale's own borough if it has no zip.
    """
    made = ["median_household_income", "population_density", "crime_rate_per_1k", "school_quality_score"]
    rows = df.drop(*made).withColumn(
        "zip_code", normalize_zip("zip_code") if "zip_code" in df.columns else F.lit(""))
    zips = cut(zip_borough(rows))
    local = zips
    for lookup in (census_by_zip(zips, census), crime_rate_by_zip(counts).select("zip_code", "crime_rate_per_1k"),
                   school_score_by_zip(zips, schools).select("zip_code", "school_quality_score")):
        local = join_on(local, lookup, ["zip_code"], "left")
    rows = join_lookup(rows, local, ["zip_code"])
    wide = borough_profile_lookup(rows.withColumn("__home", F.coalesce("zip_borough", "borough")), "__home")

    def filled(f: str, places: int | None) -> Column:
        value = F.coalesce(F.col(f).cast("double"), fallback_value(f, draw_key))
        return value.cast("bigint") if places is None else round_even(value, places)

    sources = {"census": "median_household_income", "crime": "crime_rate_per_1k", "school": "school_quality_score"}
    out = wide.withColumns({
        **{f"{s}_source": F.when(F.col(f).isNull(), "borough_fallback").otherwise(s) for s, f in sources.items()},
        "median_household_income": filled("median_household_income", None),
        "population_density": filled("population_density", None),
        "crime_rate_per_1k": filled("crime_rate_per_1k", 2),
        "school_quality_score": filled("school_quality_score", 2),
    }).drop("__home", "zip_borough", *PROFILE_NAMES)
    return walk_score_lookup(out, scores) if scores is not None else out
