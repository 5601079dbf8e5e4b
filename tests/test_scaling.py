"""Shuffles, fits and top lists whose cost per task must not grow with the table."""

import threading

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from homespan import session
from homespan.operators import classify, cluster, hyperlocal, neighbourhood, recommend, sampling, skew
from homespan.plans import inputs
from homespan.plans.base import Workspace


def test_shuffles_follow_the_rows_and_settings_come_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []

    def build():
        seen.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return spark.range(3)
    session.staged(spark, str(tmp_path), "large", build, rows=100 * session.ROWS_PER_PARTITION)
    session.staged(spark, str(tmp_path), "small", build, rows=1)
    assert seen == [100, int(before)] and spark.conf.get("spark.sql.shuffle.partitions") == before
    with pytest.raises(ValueError):
        with session.short_scans(spark):
            raise ValueError
    assert spark.conf.get(session.SPLIT_CONF) != str(session.SPLIT_BYTES)


def test_cutoffs_count_values_of_one_bucket_only(spark, monkeypatch):
    df = spark.range(4000).select((F.col("id") % 3).alias("key"), F.col("id").cast("double").alias("x")).unionByName(
        spark.createDataFrame([(1, None), (1, None), (2, -5.0), (None, 7.0)], "key long, x double"))
    counted, real = [], skew.running_totals

    def spy(cells, *args, **kwargs):
        counted.append(cells.count())
        return real(cells, *args, **kwargs)
    monkeypatch.setattr(skew, "running_totals", spy)
    got = {r.key: r.cutoff for r in skew.kth_smallest(df, ["key"], "x", lambda n: F.ceil(n * 0.5)).collect()}
    values = {k: sorted([-1.0] * 2 * (k == 1) + [-5.0] * (k == 2) + [float(i) for i in range(4000) if i % 3 == k]) for k in range(3)}
    assert got == {**{k: v[-(-len(v) // 2) - 1] for k, v in values.items()}, None: 7.0}
    assert counted[0] < 400


@pytest.mark.parametrize("k", [1, 7, 500])
def test_top_k_with_a_first_count(spark, k):
    rows = [(name, float(i % 13), i) for i in range(200) for name in ("a", "b")] + [
        ("a", None, 900), ("a", float("nan"), 901), ("b", float("inf"), 902), ("b", float("-inf"), 903), (None, 1.0, 904)]
    df = spark.createDataFrame(rows, "who string, x double, id long")
    order = [F.desc("x"), F.asc("id")]
    plain = sampling.top_k(df, ["who"], order, k).select("who", "id", "rank").collect()
    counted = sampling.top_k(df, ["who"], order, k, coarse=skew.descending_bucket(F.col("x"))).select("who", "id", "rank")
    assert sorted(plain, key=str) == sorted(counted.collect(), key=str)


def test_top_affinity_sorts_few_rows(spark):
    affinity = spark.range(5000).select(
        F.col("id").alias("property_id"), F.lit("p").alias("buyer_profile"), (F.col("id") / 5000.0).alias("affinity"))
    best = recommend.top_affinity(affinity, 3)
    assert [r.property_id for r in best.orderBy("rank").collect()] == [4999, 4998, 4997]
    assert "LeftSemi" in best._jdf.queryExecution().optimizedPlan().toString()


def _points(spark, n=240):
    rows = spark.range(n).select(F.col("id").cast("string").alias("property_id"), (F.col("id") % 3).cast("int").alias(classify.LABEL),
                                 (F.col("id") % 3).cast("double").alias("x"), F.sqrt("id").alias("y"))
    return VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(rows)


def test_large_searches_fit_one_by_one(spark, monkeypatch):
    lock, most, open_now = threading.Lock(), [], [0]

    class Counted:
        def __init__(self, **params):
            self.model = classify.classify_cart(2)

        def fit(self, rows):
            with lock:
                open_now[0] += 1
                most.append(open_now[0])
            try:
                assert not rows.storageLevel.useMemory
                return self.model.fit(rows)
            finally:
                with lock:
                    open_now[0] -= 1
    monkeypatch.setitem(classify.BUILDERS, "cart", Counted)
    monkeypatch.setattr(classify, "SIDE_BY_SIDE_ROWS", 0)
    _, _, score = classify.random_search_cv("cart", _points(spark), n=2)
    assert max(most) == 1 and len(most) == 7 and score == 1.0


def test_boosting_fits_a_class_at_a_time():
    model = classify.classify_boosted(2, 2)
    assert model.getParallelism() == 1 and not model.getClassifier().getCacheNodeIds()


def test_learning_curve_takes_digests_once(spark):
    read = []

    class Spy:
        def fit(self, rows):
            read.append("InMemoryRelation" in rows._jdf.queryExecution().withCachedData().toString())
            return classify.classify_cart(2).fit(rows)
    out = classify.learning_curve(_points(spark), Spy, (0.5, 1.0), 2).collect()
    assert len(out) == 2 and read == [True] * 4


def test_kmeans_keeps_its_own_decoded_vectors(spark, monkeypatch):
    held, fit = [], cluster.KMeans.fit

    def spy(self, data):
        held.append(data.storageLevel.useMemory)
        return fit(self, data)
    monkeypatch.setattr(cluster.KMeans, "fit", spy)
    df = spark.range(90).select(F.col("id").cast("string").alias("property_id"), (F.col("id") % 3 * 100.0).alias("lat"),
                                F.col("id").cast("double").alias("lng"))
    model = cluster.fit_kmeans(df, ["lat", "lng"], k=3, restarts=1, max_iter=3)
    assert cluster.assign_clusters(df, model).count() == 90
    assert len(cluster.elbow_scan(df, ["lat", "lng"], ks=[2], restarts=1).collect()) == 1 and held == [False, False]


def test_model_table_skips_the_enriched_stage_unless_written(spark, monkeypatch):
    from homespan.plans.base import Workspace
    monkeypatch.setattr(session, "_staged", {})
    ws = Workspace(spark, "/root/testdata/sf0.001")
    kept = ["property_id", "valuation_label", *neighbourhood.PERCENTILES.values()]
    direct = ws.model_table()
    assert sorted(k[2] for k in session._staged) == ["model_table", "properties"]
    again = Workspace(spark, "/root/testdata/sf0.001/")
    again.enriched()
    session._staged.pop(next(k for k in session._staged if k[2] == "model_table"))
    staged = again.model_table()
    a, b = direct.select(kept), staged.select(kept)
    assert direct.columns == staged.columns and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_percent_ranks_order_a_column_once(spark):
    """Neither ties nor totals may ask for a second order of the rows."""
    rows = [("a", 1.0, 5), ("a", 1.0, None), ("a", 2.0, 5), ("a", None, 7), ("b", 4.0, None), (None, 3.0, 2), (None, 9.0, 2)]
    df = spark.createDataFrame(rows, "key string, x double, y int")
    out = skew.percent_ranks(df, "key", {"x": "rx", "y": "ry"})
    normal = out._jdf.queryExecution().optimizedPlan().toString().split("LeftAnti")[0]
    assert normal.count("Window [") == normal.count("Window [rank(") == 2
    got = sorted(((r.key, r.x, r.y, r.rx, r.ry) for r in out.collect()), key=str)
    want = [("a", 1.0, 5, 0.5, 0.5), ("a", 1.0, None, 0.5, None), ("a", 2.0, 5, 1.0, 0.5), ("a", None, 7, None, 1.0),
            ("b", 4.0, None, 1.0, None), (None, 3.0, 2, 0.5, 0.75), (None, 9.0, 2, 1.0, 0.75)]
    assert got == sorted(want, key=str)


@pytest.fixture
def few_sales(spark, tmp_path, monkeypatch):
    """A folder of order tables with 120 sales, no stage of it written yet."""
    monkeypatch.setattr(session, "_staged", {})
    made = {
        "region": spark.createDataFrame([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int"),
        "customer": spark.range(4).selectExpr("id as c_custkey", "cast(id % 2 as int) as c_nationkey"),
        "part": spark.range(10).selectExpr("id as p_partkey", "if(id < 5, 'LARGE', 'SMALL') as p_type"),
        "orders": spark.range(40).selectExpr("id as o_orderkey", "id % 4 as o_custkey"),
        "lineitem": spark.range(120).selectExpr(
            "id % 40 as l_orderkey", "id % 10 as l_partkey", "id % 3 as l_suppkey", "cast(1 + id % 3 as int) as l_linenumber",
            "cast(1 + id % 7 as double) as l_quantity", "if(id = 9, null, 100.0 + (id * id) % 97) as l_extendedprice",
            "'R' as l_returnflag", "timestamp_ntz'1996-09-13 00:00:00' as l_shipdate")}
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return Workspace(spark, str(tmp_path))


def test_rules_are_judged_without_whole_sales(few_sales):
    got = inputs.judged(few_sales).collect()
    stages = {name for _, _, name in session._staged}
    assert stages == {"properties", "judged"}
    want = few_sales.model_table().select("property_id", "valuation_label", "ppsf_neighborhood_percentile").collect()
    assert sorted((r.property_id, r.actual, r.p) for r in got) == sorted(tuple(r) for r in want) and len(got) == 119


def test_draws_take_each_digest_once(spark):
    df = spark.createDataFrame([("1-2", "BROOKLYN"), ("3-4", None), (None, "QUEENS")], "property_id string, borough string")
    out = hyperlocal.hyperlocal_fallback(df, "property_id")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 14
    wide = hyperlocal.borough_profile_lookup(df)
    fields = list(hyperlocal.V.FALLBACK_LIMITS)
    plain = wide.select("property_id", *[hyperlocal.fallback_value(f, "property_id").alias(f"fallback_{f}") for f in fields])
    assert sorted(out.select(*plain.columns).collect(), key=str) == sorted(plain.collect(), key=str)


def test_landed_sales_are_written_packed(ws):
    from pathlib import Path

    from homespan.sources import landed

    path = Path(inputs.landed_sales(ws).removeprefix("file:"))
    parts = [f for f in path.iterdir() if f.name.startswith("part-")]
    assert parts and all(f.name.endswith(".json.gz") for f in parts)
    assert landed.read_sales_json(ws.spark, str(path)).count() == ws.properties().count()


def test_stored_cluster_vectors_hold_what_the_fits_read(ws):
    data, _ = cluster.vectors(ws.area_features())
    assert data.columns == ["scaled"] and data.count() == ws.area_features().count()
    assert all(f.endswith(".zstd.parquet") for f in data.inputFiles())
    assert cluster.vectors(ws.area_features(), keep=["property_id"])[0].columns == ["property_id", "scaled"]


def test_cluster_queries_store_their_own_columns_only(spark, tmp_path):
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    own = Workspace(spark, str(tmp_path))
    narrow = own.area_features()
    assert not session.is_staged(spark, own.source, "features") and "price" not in narrow.columns
    whole = own.features().select(*narrow.columns)
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, whole.collect()))
    assert sorted(own.area_features().inputFiles()) == sorted(own.features().inputFiles())  # no second copy after that


def test_fits_stage_their_inputs_only(spark, tmp_path):
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    own = Workspace(spark, str(tmp_path))
    narrow = own.model_inputs()
    assert not session.is_staged(spark, own.source, "model_table")
    assert {"property_id", "valuation_label"} < set(narrow.columns) and not {"price", "sale_date", "peer_z"} & set(narrow.columns)
    whole = own.model_table().select(*narrow.columns)
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, whole.collect()))
    assert sorted(own.model_inputs().inputFiles()) == sorted(own.model_table().inputFiles())  # no second copy after that


def test_prepared_rows_are_stored_packed_and_forests_store_no_node_numbers(ws):
    train, test, _ = classify.split_prepared(ws.model_inputs())
    assert train.count() + test.count() == ws.model_table().count()
    assert all(f.endswith(".zstd.parquet") for f in train.inputFiles())
    assert not classify.classify_random_forest().getCacheNodeIds()
