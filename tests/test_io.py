"""Sources, sinks, freshness, quality checks, streams and the stage runner."""

import json
import os

import pytest
from pyspark.sql import functions as F

from homespan.functions import values as V
from homespan.operators import quality
from homespan.plans import base, stages
from homespan.sources import landed, models, tables
from homespan.streaming import sales as live


def test_ingest_writes_once_unless_forced(spark, tmp_path):
    path = str(tmp_path / "raw")
    sources = {name: lambda v=v: spark.range(1).withColumn("v", F.lit(v)) for name, v in (("a", 1), ("b", 2))}
    assert tables.ingest(spark, path, sources, "a").first().v == 1
    assert tables.ingest(spark, path, sources, "b").first().v == 1
    assert tables.ingest(spark, path, sources, "b", force=True).first().v == 2
    with pytest.raises(ValueError):
        tables.ingest(spark, path, sources, "c")


def test_comparison_table_through_csv(spark, tmp_path):
    row = ("cart", 0.5571, 0.4611, 0.5, 0.4, 0.3, None, 0.1711, 21.21, 0.025)
    df = spark.createDataFrame([row], tables.COMPARISON_SCHEMA)
    tables.write_csv(df, str(tmp_path / "c"))
    assert tuple(tables.read_csv(spark, str(tmp_path / "c")).first()) == row


def test_frame_models(spark, tmp_path):
    from pyspark.sql import DataFrame
    models.save_model(spark.range(3), str(tmp_path / "m"))
    assert models.load_model(spark, str(tmp_path / "m"), DataFrame).count() == 3


def test_snapshot_time_to_live(spark):
    df = spark.sql("""select * from values (1, timestamp_ntz'2024-01-01 10:00:00'), (2, timestamp_ntz'2024-01-01 10:30:00'),
                      (3, timestamp_ntz'2024-01-01 12:00:00') t(id, fetched_at)""")
    pick = lambda now: [r.id for r in landed.latest_fresh_snapshot(df, now, 1).collect()]
    assert pick("2024-01-01 11:00:00") == [2] and pick("2024-01-01 11:45:00") == [] and pick("2024-01-01 12:30:00") == [3]
    row = landed.data_freshness(df, "sales", "2024-05-01 00:00:00").first()
    assert (row.row_count, row.state, row.last_update) == (3, "stale", "2024-01-01")


GOOD = dict(property_id="a", borough="QUEENS", lat=40.7, lng=-74.0, sqft=100, lot_sqft=100, year_built=1990, num_units=1,
            num_floors=1, walk_score=50.0, transit_score=50.0, bike_score=50.0, crime_rate_per_1k=1.0,
            school_quality_score=5.0, median_household_income=1, price=1, price_per_sqft=1.0, flood_zone_flag=0)


@pytest.mark.parametrize("column,value,rule", [
    ("lat", 41.0, "lat:range"), ("borough", "X", "borough:allowed"), ("sqft", 0, "sqft:above"), ("num_units", 0, "num_units:range"),
    ("flood_zone_flag", 2, "flood_zone_flag:allowed"), ("school_quality_score", 10.5, "school_quality_score:range"),
    ("property_id", None, "property_id:not_null"), ("price_per_sqft", 0.0, "price_per_sqft:above")])
def test_each_rule_is_caught(spark, column, value, rule):
    kinds = {str: "string", float: "double", int: "int"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in GOOD.items())
    df = spark.createDataFrame([tuple({**GOOD, column: value}.values())], schema)
    assert [r.rule for r in quality.validate_properties(df).filter("failures > 0").collect()] == [rule]
    with pytest.raises(ValueError, match=column):
        quality.require_valid(df)
    fine = spark.createDataFrame([tuple(GOOD.values())], schema)
    assert quality.require_valid(fine) is fine
    assert quality.validate_basic(fine).filter("failed").count() == 0
    gone = quality.validate_properties(fine.drop("price")).filter("failures > 0").collect()
    assert [r.rule for r in gone] == ["price:column_present"]


def record(**over):
    row = {k: None for k in V.SALES_FIELDS}
    return {**row, "borough": "3", "gross_square_feet": "1500", "sale_price": "950000", "sale_date": "2025-09-01T00:00:00.000",
            "total_units": "2", "address": "1 Main St", **over}


def land(folder, name, *records):
    """Write a page; its age follows its number, so that streams read pages in order."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))
    os.utime(folder / name, (int(name[0]) * 100, int(name[0]) * 100))


def test_stream_reads_each_sale_once_and_drops_late_ones(spark, tmp_path):
    src = tmp_path / "landed"
    land(src, "1.json", record(), record(sale_price="1"), record(address="2 Main St", sale_date="n/a"))
    stream = live.stream_sales(spark, str(src), files_per_batch=1)
    first = live.run_available(stream, "t1")
    row = first.collect()
    assert len(row) == 1 and row[0].borough == "BROOKLYN" and row[0].price == 950000 and row[0].sale_year == 2025
    land(src, "2.json", record(), record(address="3 Main St", sale_date="2025-11-01"))
    land(src, "3.json", record(address="4 Main St", sale_date="2020-01-01"))
    out = live.run_available(live.stream_sales(spark, str(src), files_per_batch=1), "t2")
    assert sorted(r.address for r in out.collect()) == ["1 Main St", "3 Main St"]


def test_stream_upsert_keeps_the_newest(spark, tmp_path):
    src = tmp_path / "rows"
    land(src, "1.json", {"k": "a", "v": 1}, {"k": "b", "v": 1})
    land(src, "2.json", {"k": "a", "v": 2})
    stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).json(str(src))
    got = live.upsert_available(stream, ["k"], "up")
    assert sorted((r.k, r.v) for r in got.collect()) == [("a", 2), ("b", 1)]


def test_stages_end_to_end(spark, tmp_path, ws):
    source = ws.source
    runner = stages.Stages(spark, str(tmp_path), lambda: base.properties_from(base.Workspace(spark, source).table))
    quick = {"random_forest": {"num_trees": 3, "max_depth": 3}}
    done = runner.run("all", tune=False, names=["cart", "random_forest"], params=quick, clusters=4, restarts=1)
    assert set(done) == {"ingest", "enrich", "features", "train", "recommend", "cluster"}
    rows = tables.read_table(spark, f"{tmp_path}/processed/properties_clustered")
    assert rows.count() == 6000 and rows.filter("cluster_name is null").count() == 0
    assert tables.read_csv(spark, f"{tmp_path}/models/classifier_comparison").count() == 2
    with pytest.raises(ValueError):
        runner.run("paint")


def test_shared_folder_setting_is_read(spark, tmp_path):
    from homespan import session
    old = spark.conf.get(session.CHECKPOINT_CONF, None)
    assert session.shared_dir(spark)
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")
    assert spark.conf.get(session.CHECKPOINT_CONF, None) == old
