"""The hot-group routes must give what the plain routes and NumPy/pandas give."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from homespan.operators import skew


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(7)
    key = np.where(rng.random(4000) < 0.4, "hot", rng.integers(0, 30, 4000).astype(str))
    pdf = pd.DataFrame({"key": key, "x": np.round(rng.lognormal(4, 2, 4000), 2), "y": rng.integers(-5, 6, 4000) * 1.0})
    pdf.loc[rng.random(4000) < 0.05, "x"] = np.nan
    pdf.loc[rng.random(4000) < 0.02, "key"] = None
    return pdf, spark.createDataFrame(pdf.astype({"key": object})).withColumns(
        {"x": F.nanvl("x", F.lit(None)), "id": F.monotonically_increasing_id()}).repartition(5)


@pytest.mark.parametrize("hot_rows", [1, 200, 10**9])
def test_group_quantiles(table, hot_rows):
    pdf, df = table
    got = {r.key: r for r in skew.group_quantiles(df, ["key"], ["x", "y"], (0.0, 0.1, 0.5, 1.0),
                                                  [F.count(F.lit(1)).alias("n")], hot_rows).collect()}
    groups = pdf.assign(key=pdf.key.fillna("~")).groupby("key")
    assert len(got) == len(groups)
    for key, part in groups:
        row = got[None if key == "~" else key]
        assert row.n == len(part)
        for c in ("x", "y"):
            np.testing.assert_allclose(row[c], part[c].dropna().quantile([0.0, 0.1, 0.5, 1.0]), atol=1e-8)


@pytest.mark.parametrize("hot_rows", [10, 10**9])
def test_whole_table_median(table, hot_rows):
    pdf, df = table
    row = skew.group_medians(df, [], ["x", "y"], hot_rows=hot_rows).collect()
    assert len(row) == 1 and row[0].x == pytest.approx(pdf.x.median()) and row[0].y == pdf.y.median()


def test_empty_and_all_null_groups(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "key string, x double")
    for hot_rows in (0, 10**9):
        got = {r.key: r.x for r in skew.group_medians(df, ["key"], ["x"], hot_rows=hot_rows).collect()}
        assert got == {"a": None, "b": 2.0}
    assert skew.group_medians(df.limit(0), ["key"], ["x"]).count() == 0


@pytest.mark.parametrize("hot_rows", [1, 200, 10**9])
def test_percent_ranks_match_average_ranks(table, hot_rows):
    pdf, df = table
    df = df.withColumn("key", F.coalesce("key", F.lit("~")))
    got = skew.percent_ranks(df, "key", {"x": "rx", "y": "ry"}, hot_rows).toPandas().sort_values("id")
    assert len(got) == len(pdf)
    for c, r in (("x", "rx"), ("y", "ry")):
        np.testing.assert_allclose(got[r], got.groupby("key")[c].rank(pct=True), atol=1e-12)


def test_running_totals_both_ways(table):
    pdf, df = table
    cells = df.filter("x is not null and key is not null").groupBy("key", "x").agg(F.count(F.lit(1)).alias("n"))
    for down in (False, True):
        got = skew.running_totals(cells, ["key"], "x", ["n"], descending=down).toPandas().sort_values(
            ["key", "x"], ascending=[True, not down])
        want = got.groupby("key").n.cumsum() - got.n
        assert (got.n_before == want).all()


def test_kth_smallest(table):
    pdf, df = table
    got = {r.key: r.cutoff for r in skew.kth_smallest(
        df.filter("x is not null and key is not null"), ["key"], "x", lambda n: F.ceil(n * F.lit(0.3))).collect()}
    for key, part in pdf.dropna().groupby("key"):
        assert got[key] == np.sort(part.x)[int(np.ceil(len(part) * 0.3)) - 1]


def test_lookup_gives_the_same_broadcast_or_shuffled(table, spark):
    _, df = table
    small = df.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    wide = skew.join_lookup(df, small, ["key"], max_rows=0)
    near = skew.join_lookup(df, small, ["key"])
    assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()
    assert sorted(wide.select("id", "n").collect()) == sorted(near.select("id", "n").collect())
    assert wide.filter("n is null").count() == 0


def test_tiny_numbers_keep_their_quantiles_and_buckets(spark):
    from homespan.operators import skew

    tiny = spark.createDataFrame([(1e-10,), (2e-10,), (3e-10,)], "x double")
    assert skew.group_medians(tiny, [], ["x"]).first().x == 2e-10
    values = [-1e300, -3.0, -1e-9, -1e-310, 0.0, 1e-310, 1e-9, 2e-9, 4e-5, 3.0, 1e300]
    buckets = [r.b for r in spark.createDataFrame([(v,) for v in values], "x double").select(
        skew.value_bucket(skew.F.col("x")).alias("b")).collect()]
    assert buckets == sorted(buckets) and len(set(buckets)) == len(values)
