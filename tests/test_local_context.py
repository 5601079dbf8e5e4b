"""Zip, precinct, school, census and walk-score lookups on literal cases."""

import pytest
from pyspark.sql import functions as F

from homespan.functions.scalar import normalize_zip
from homespan.operators import geo, hyperlocal as hl
from homespan.sources import landed


@pytest.mark.parametrize("raw,want", [(None, ""), ("00000", ""), ("0", ""), ("7030", "07030"), (" 10001 ", "10001"),
                                      ("10001-1234", "10001-1234"), ("", "")])
def test_normalize_zip(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "z string").select(normalize_zip("z").alias("z")).first().z == want


def test_crime_rates(spark):
    counts = spark.createDataFrame([("1", 100), (" 5 ", 10**6), ("", 7)], "addr_pct_cd string, n bigint")
    got = {r.zip_code: r for r in hl.crime_rate_by_zip(counts).collect()}
    assert got["10006"].crime_rate_per_1k == 2.0 and got["10006"].complaint_count == 100
    assert got["10012"].crime_rate_per_1k == 80.0  # clipped
    assert got["10014"].crime_rate_per_1k == 1.0   # precinct without complaints
    assert "99999" not in got
    assert hl.crime_rate_by_zip(counts.limit(0)).count() == 0


@pytest.mark.parametrize("n,score", [(0, 5.5), (1, 6.5), (3, 7.0), (5, 7.5)])
def test_school_scores(spark, n, score):
    zips = spark.createDataFrame([("11201", "nowhere")], "zip_code string, zip_borough string")
    schools = spark.createDataFrame([("x", "10001")] + [(f"s{i}", "11201") for i in range(n)], "dbn string, zip string")
    assert hl.school_score_by_zip(zips, schools).first().school_quality_score == score


def test_census_rules(spark):
    payload = '[["B19013_001E","B01003_001E","zip"],["{}","{}","{}"]]'
    raw = spark.createDataFrame([("1", payload.format(50000, 100, 1)), ("2", payload.format(-666666666, -1, 2)),
                                 ("3", payload.format(70000, 99999, 3)), ("4", '[["B19013_001E"]]'), ("5", "broken")],
                                "zip string, payload string")
    census = landed.read_census(raw)
    zips = spark.createDataFrame([(f"0000{i}", "QUEENS") for i in range(1, 6)], "zip_code string, zip_borough string")
    got = {r.zip_code: r for r in hl.census_by_zip(zips, census).collect()}
    assert (got["00001"].median_household_income, got["00001"].population_density) == (50000, 1200)
    assert (got["00002"].median_household_income, got["00002"].population_density) == (72000, 110000)
    assert got["00003"].population_density == 110000 and set(got) == {"00001", "00002", "00003"}


def test_walk_scores_and_zero(spark):
    raw = spark.createDataFrame([
        (40.7, -74.0, '{"status":1,"walkscore":0,"transit":{"score":50}}'),
        (40.8, -74.0, '{"status":40,"walkscore":99}')], "lat double, lng double, payload string")
    scores = landed.read_walk_scores(raw)
    assert scores.count() == 1
    sales = spark.createDataFrame([("a", "BRONX", 40.70001, -74.0), ("b", "BRONX", 40.8, -74.0)],
                                  "property_id string, borough string, lat double, lng double")
    got = {r.property_id: r for r in hl.walk_score_lookup(sales, scores).collect()}
    assert (got["a"].walk_score, got["a"].transit_score, got["a"].bike_score) == (75.0, 50.0, 70.0)
    assert got["b"].walk_source == "borough_fallback" and got["a"].walk_source == "walk_scores"


def test_missing_sources_fall_back(spark):
    sales = spark.createDataFrame([("a", "BRONX", "10001"), ("b", "atlantis", None)],
                                  "property_id string, borough string, zip_code string")
    census = spark.createDataFrame([], "zip string, B19013_001E bigint, B01003_001E bigint")
    counts = spark.createDataFrame([], "addr_pct_cd string, n bigint")
    schools = spark.createDataFrame([], "dbn string, zip string")
    got = {r.property_id: r for r in hl.enrich_hyperlocal(sales, census, counts, schools).collect()}
    assert got["a"].median_household_income == 45000 and got["b"].median_household_income == 78000
    assert got["a"].crime_rate_per_1k == 35.0 and got["a"].school_source == "borough_fallback"
    drawn = hl.enrich_hyperlocal(sales, census, counts, schools, draw_key="property_id").collect()
    assert all(1 <= r.crime_rate_per_1k <= 80 and 20000 <= r.median_household_income <= 350000 for r in drawn)


def test_historic_complaints_only_without_current(spark):
    schema = "addr_pct_cd string, cmplnt_dt timestamp_ntz"
    old = spark.sql("select '7' as addr_pct_cd, timestamp_ntz'2023-05-01' as cmplnt_dt union all select '8', timestamp_ntz'2022-05-01'")
    none = spark.createDataFrame([], schema)
    assert {r.source for r in landed.read_complaint_counts(none, old).collect()} == {"historic"}
    assert landed.read_complaint_counts(none, old, year=2023).count() == 1
    assert {r.source for r in landed.read_complaint_counts(old, old).collect()} == {"current"}


def test_coordinates_only_if_none_given(spark):
    df = spark.createDataFrame([("a", "QUEENS", None, None), ("b", "?", None, None)],
                               "property_id string, borough string, lat double, lng double")
    got = {r.property_id: r for r in geo.impute_coordinates(df).collect()}
    assert 40.54 <= got["a"].lat <= 40.8 and 40.57 <= got["b"].lat <= 40.74 and got["a"].coordinates_imputed
    given = geo.impute_coordinates(df.withColumn("lat", F.lit(40.0)))
    assert given.filter("coordinates_imputed or lat <> 40.0").count() == 0


def test_heat_weights_of_constant_metric(spark):
    df = spark.createDataFrame([(str(i), 40.0, -74.0, 5.0) for i in range(9)],
                               "property_id string, lat double, lng double, walk_score double")
    assert geo.heatmap_weights(df, "walk_score").count() == 9
    with pytest.raises(ValueError):
        geo.heatmap_weights(df, "nope")
