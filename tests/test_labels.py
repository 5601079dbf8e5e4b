"""Neighbourhood keys, peers and labels on literal edge cases and the driver tables."""

import pytest
from pyspark.sql import functions as F

from homespan.operators import neighbourhood as nb, projections, sampling, stats

SCHEMA = "property_id string, borough string, lat double, lng double, num_units int, price double, price_per_sqft double, sqft bigint"


def rows(spark, *groups):
    out = []
    for g, (borough, units, prices) in enumerate(groups):
        for i, p in enumerate(prices):
            out.append((f"{g}-{i}", borough, 40.0 + g, -74.0, units, 100.0, p, 10))
    return spark.createDataFrame(out, SCHEMA)


def test_keys(spark):
    df = spark.createDataFrame(
        [("a", "Q", 40.704, -73.996), ("b", None, 40.0, None), ("c", "Q", 40.715, -74.005)],
        "id string, borough string, lat double, lng double")
    got = {r.id: r.nta_proxy for r in nb.assign_neighborhood(df).collect()}
    assert got["a"] == "Q_40.7_-74.0" and got["b"] == "nan_40.0_nan"


@pytest.mark.parametrize("units,name", [(0, "nan"), (1, "1u"), (2, "2u"), (3, "3-4u"), (4, "3-4u"), (5, "5-8u"),
                                        (8, "5-8u"), (9, "9+u"), (1000, "9+u"), (1001, "nan"), (None, "nan")])
def test_unit_bucket(spark, units, name):
    df = spark.createDataFrame([(units,)], "u int").select(nb.unit_bucket(F.col("u")).alias("b"))
    assert df.first().b == name


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_zscore_cases(spark, hot_rows):
    df = rows(spark, ("Q", 1, [10.0, 20.0, 30.0, 40.0, 50.0]),   # five peers: own group
              ("Q", 1, [10.0, 20.0, 30.0, 90.0]),                # four peers: borough
              ("R", 1, [7.0]), ("S", 1, [5.0] * 6),              # one row; no spread
              (None, 1, [3.0, 9.0]))                             # no borough to fall back on
    got = {r.property_id: r for r in nb.valuation_label(nb.peer_zscore(df, hot_rows)).collect()}
    assert got["0-4"].peer_z == pytest.approx(20 / 15.811388, abs=1e-6) and got["0-4"].valuation_label == 2
    assert got["0-0"].valuation_label_name == "undervalued"
    prices = [10, 20, 30, 40, 50, 10, 20, 30, 90]
    mean = sum(prices) / 9
    std = (sum((p - mean) ** 2 for p in prices) / 8) ** 0.5
    assert got["1-3"].peer_z == pytest.approx((90 - 30) / std)
    assert got["2-0"].peer_z == 0 and got["3-2"].peer_z == 0 and got["4-0"].peer_z == 0
    assert got["2-0"].peer_std_ppsf is not None  # filled with the weighted mean


def test_division_by_zero_gives_null(spark):
    df = spark.createDataFrame([(2000, 10, 0, 5.0, 0, 1, 50.0, 50.0, 5.0, 10.0, 100, 100, 2023, 2)],
                               "year_built int, sqft int, num_units int, price double, lot_sqft int, num_floors int, "
                               "walk_score double, transit_score double, school_quality_score double, "
                               "crime_rate_per_1k double, nearest_subway_m int, nearest_park_m int, sale_year int, sale_quarter int")
    row = projections.engineer_features(df).first()
    assert row.sqft_per_unit is None and row.floor_area_ratio is None
    assert row.building_age == 24 and row.market_cycle_index == 1.25 and row.amenity_score == 1.375


def test_percentiles_in_unit_range_and_labels_complete(ws):
    df = ws.model_table()
    for c in nb.PERCENTILES.values():
        assert df.filter(~F.col(c).between(0, 1)).count() == 0
    assert df.select("valuation_label").distinct().count() == 3


def test_row_order_and_partitions_do_not_matter(ws):
    a = nb.valuation_label(nb.peer_zscore(ws.properties()))
    b = nb.valuation_label(nb.peer_zscore(ws.properties().orderBy(F.rand(3)).repartition(13)))
    c = nb.valuation_label(nb.peer_zscore(ws.properties(), hot_rows=20))
    keep = ["property_id", "valuation_label"]
    for other in (b, c):
        assert a.select(*keep).exceptAll(other.select(*keep)).count() == 0


@pytest.mark.parametrize("mode", ["declared", "dtype"])
def test_no_leaking_columns(ws, mode):
    numeric, categorical = projections.select_features(ws.model_table().drop("buyer_key", "item_key"), mode)
    leaks = {"price", "price_per_sqft", "peer_z", "valuation_label", "property_id", "ppsf_neighborhood_percentile"}
    assert not leaks & set(numeric + categorical) and "borough" in categorical
    with pytest.raises(ValueError):
        projections.select_features(ws.model_table(), "other")


def test_split_is_exact_per_label_and_stable(ws):
    a = sampling.stratified_split(ws.features())
    b = sampling.stratified_split(ws.features().repartition(11))
    assert a.select("property_id", "is_test").exceptAll(b.select("property_id", "is_test")).count() == 0
    for r in a.groupBy("valuation_label").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect():
        assert 0 <= r.t - -(-r.n // 5) <= 1  # one more only for a repeated id


def test_large_sample_route_has_exact_size(spark, monkeypatch):
    df = spark.range(5000).withColumn("property_id", F.col("id").cast("string")).unionByName(
        spark.range(50).withColumn("property_id", F.lit("same")))
    small = {r.id for r in sampling.sample_n(df, 700).collect()}
    monkeypatch.setattr(sampling, "IN_ONE_TASK", 10)
    large = sampling.sample_n(df, 700).collect()
    assert len(large) == 700
    assert len(small ^ {r.id for r in large}) <= 50


def test_live_defaults(spark):
    df = spark.createDataFrame([("BROOKLYN", 1500.0, None, None, None, 950000.0), ("QUEENS", 100.0, 100.0, 1700.0, 5.0, 1.0)],
                               "borough string, sqft double, lot_sqft double, year_built double, num_units double, price double")
    a, b = projections.default_live_fields(df).orderBy("borough").collect()
    assert (a.lot_sqft, a.year_built, a.num_units, a.num_floors, a.building_class) == (2250, 1970, 1, 1, "Unknown")
    assert (b.lot_sqft, b.year_built, b.num_units, b.num_floors) == (500, 1800, 5, 2)
    ids = projections.assign_live_id(df).select("property_id").collect()
    assert all(r.property_id.startswith("LIVE_") for r in ids) and len(set(ids)) == 2


def test_union_tops_up_to_target(ws):
    a = ws.properties().filter("sale_year < 1996").select("property_id", "price")
    b = ws.properties().filter("sale_year >= 1996").select("property_id", "price", "sqft")
    n = a.count()
    out = stats.union_sources(a, b, n + 25)
    assert out.columns == ["property_id", "price", "data_source"]
    assert {r.data_source: r["count"] for r in out.groupBy("data_source").count().collect()} == {"live_nyc_dof": n, "synthetic": 25}


def test_live_ids_of_many_sales_at_one_price(spark):
    sales = spark.range(1_000_000).selectExpr("cast(id as string) as address", "500000.0 as price")
    assert projections.assign_live_id(sales).select("property_id").distinct().count() == 1_000_000
