"""Neighbour search, metrics, recommenders, clusters and classifiers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from homespan.functions import values as V
from homespan.operators import classify, cluster, evaluate, neighbours, prepare, projections, recommend
from homespan.sources import models


def points(spark, n, d, seed, spread=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)) + rng.integers(0, spread, (n, 1)) * 4, 3)
    return x, spark.createDataFrame([(int(i), [float(v) for v in r], int(i % 3)) for i, r in enumerate(x)],
                                    "id bigint, features array<double>, label int")


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("block,chunk", [(40, 30), (10**6, 10**6)])
def test_knn_join_is_exact(spark, p, block, chunk):
    x, train = points(spark, 400, 3, 1)
    y, test = points(spark, 120, 3, 2, spread=4)
    got = neighbours.knn_join(test.drop("label"), train, 6, p, block, chunk).toPandas()
    d = np.abs(y[:, None] - x[None]) ** p
    d = np.rint(d.sum(2) ** (1 / p) * 1e9) / 1e9
    assert len(got) == 120 * 6
    for i, part in got.groupby("test_id"):
        want = np.lexsort((np.arange(400), d[i]))[:6]
        assert part.sort_values("rank").train_id.tolist() == want.tolist()


def test_knn_with_hot_copies_and_few_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 1.0], i % 2) for i in range(200)], "id bigint, features array<double>, label int")
    test = spark.createDataFrame([(1, [1.0, 1.0]), (2, [9.0, 9.0])], "id bigint, features array<double>")
    got = neighbours.knn_join(test, same, 3, 2, 20, 20).orderBy("test_id", "rank").collect()
    assert [r.train_id for r in got] == [0, 1, 2, 0, 1, 2]
    assert neighbours.knn_join(test, same.limit(2), 5).count() == 4  # fewer rows than k
    with pytest.raises(ValueError):
        neighbours.knn_join(test, same, 3, 3)


def test_votes(spark):
    found = spark.createDataFrame([(1, 0, 0, 0.0, 1), (1, 1, 1, 1e-6, 2), (1, 2, 1, 1e-6, 3), (2, 3, 1, 2.0, 1), (2, 4, 0, 2.0, 2)],
                                  "test_id int, train_id int, label int, distance double, rank int")
    near = {r.test_id: r for r in neighbours.vote(found).collect()}
    assert near[1].prediction == 0 and near[1].share == 1.0 and near[2].prediction == 0
    flat = {r.test_id: r for r in neighbours.vote(found, "uniform").collect()}
    assert flat[1].prediction == 1 and flat[1].share == pytest.approx(2 / 3)


def test_metrics_by_hand(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 6 + [(2, 1)] * 3 + [(1, 5)]
    df = spark.createDataFrame(pairs, "a int, p int")
    row = evaluate.classifier_metrics(df, "a", "p").first()
    f1 = [2 * 5 / (7 + 5), 2 * 6 / (7 + 11), 0.0, 0.0]  # classes 0, 1, 2, 5
    assert row.accuracy == pytest.approx(11 / 17, abs=1e-6) and row.f1_macro == pytest.approx(sum(f1) / 4, abs=1e-6)
    chance = (7 * 5 + 7 * 11) / 17**2
    assert row.cohen_kappa == pytest.approx((11 / 17 - chance) / (1 - chance), abs=1e-6)
    one = spark.createDataFrame([(1, 1)] * 3, "a int, p int")
    assert evaluate.classifier_metrics(one, "a", "p").first().cohen_kappa is None


def test_auc_with_ties_and_missing_class(spark):
    rng = np.random.default_rng(3)
    score, y = np.round(rng.random(300), 1), rng.integers(0, 2, 300)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": score}))
    pos, neg = score[y == 1], score[y == 0]
    want = ((pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean())
    got = {r["class"]: r.auc for r in evaluate.roc_auc_ovr(df, "y", {1: F.col("s"), 0: 1 - F.col("s"), 2: F.col("s")}).collect()}
    assert got[1] == pytest.approx(want, abs=1e-6) and got[0] == pytest.approx(want, abs=1e-6)
    assert got[2] is None and got[-1] is None
    curve = evaluate.roc_curve(df, "y", {1: F.col("s")}).toPandas().sort_values(["fpr", "tpr"])
    assert np.trapezoid(curve.tpr, curve.fpr) == pytest.approx(want, abs=1e-5)


def test_ranking_metrics(spark):
    lists = spark.createDataFrame([("r", i + 1, f"p{i}") for i in range(6)], "request string, rank int, property_id string")
    good = spark.createDataFrame([("p0",), ("p2",), ("p99",)], "property_id string")
    got = {r.k: r for r in evaluate.recommender_metrics(lists, good, (1, 5, 20)).collect()}
    assert got[1].precision == 1 and got[5].recall == pytest.approx(2 / 3, abs=1e-6) and got[20].precision == 0.1
    ideal = 1 + 1 / np.log2(3) + 0.5
    assert got[5].ndcg == pytest.approx((1 + 0.5) / ideal, abs=1e-6)
    none = evaluate.recommender_metrics(lists, good.limit(0), (5,)).first()
    assert (none.precision, none.recall, none.ndcg) == (0, 0, 0)
    assert evaluate.catalog_coverage(lists, lists.select("property_id")).first().coverage == 1


def test_similar_matches_numpy_and_respects_filters(ws):
    df = ws.features().filter("valuation_label <> 1 or price > 50000")
    model = recommend.fit_content(df)
    seed = df.orderBy("property_id").limit(1)
    got = recommend.recommend_similar(df, seed, 7, "undervalued", 60000, True, model).collect()
    pdf = recommend.content_features(df, model).toPandas()
    s = pdf[pdf.property_id == seed.first().property_id].iloc[0]
    x = np.stack(pdf.features)
    sim = x @ s.features / np.linalg.norm(x, axis=1) / np.linalg.norm(s.features)
    ok = (pdf.valuation_label_name == "undervalued") & (pdf.price <= 60000) & (pdf.borough == s.borough) \
        & (pdf.property_id != s.property_id)
    assert [r.similarity for r in got] == pytest.approx(sorted(sim[ok], reverse=True)[:7], abs=1e-8)
    assert [r["rank"] for r in got] == list(range(1, 8))


def test_preferences_budget_and_short_lists(ws):
    asked = {"cheap": {"budget_max": 20000, "prefer_safe": True}, "none": {"borough": "atlantis"}}
    got = recommend.recommend_from_preferences(ws.features(), asked, 10)
    assert got.filter("price > 20000").count() == 0 and {r.request for r in got.select("request").distinct().collect()} == {"cheap"}
    few = recommend.recommend_from_preferences(ws.features().limit(3), {"all": {"prefer_walkable": True}}, 10)
    assert few.count() == 3


def test_minmax_of_one_candidate(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("b", 2.0)], "r string, s double")
    got = sorted(df.select("r", recommend.minmax("s", ["r"]).alias("m")).collect())
    assert [x.m for x in got] == [0.5, 0.0, 1.0]


def test_ratings_stay_in_range_and_skip_seen(ws, spark):
    known = ws.interactions()
    items = ws.table("part").select(F.col("p_partkey").alias("property_id"))
    buyers = spark.createDataFrame([(1,), (2,), (10**9,)], "buyer_id bigint")
    got = recommend.recommend_for_buyer(items, known, buyers, 15)
    assert got.filter("predicted_rating < 1 or predicted_rating > 5").count() == 0
    assert got.groupBy("buyer_id").count().filter("count <> 15").count() == 0
    assert got.join(known, ["buyer_id", "property_id"]).count() == 0
    model, rows = recommend.fit_collaborative(known, rank=4, epochs=3)
    scored = recommend.predict_factors(model, rows)
    assert scored.filter("predicted_rating < 1 or predicted_rating > 5").count() == 0
    plain = known.agg(F.stddev_pop("rating")).first()[0]
    rmse = scored.agg(F.sqrt(F.avg((F.col("rating") - F.col("predicted_rating")) ** 2))).first()[0]
    assert rmse < plain


def test_affinity_ratings(ws):
    got = recommend.profile_affinity(ws.features())
    assert got.select("buyer_profile").distinct().count() == len(V.BUYER_PROFILES)
    assert got.filter("rating < 1 or rating > 5").count() == 0


def test_every_cluster_is_named(ws, spark):
    model = cluster.fit_kmeans(ws.features(), k=5, restarts=2, max_iter=20)
    rows = cluster.assign_clusters(ws.features(), model)
    named = cluster.name_clusters(cluster.cluster_profiles(rows)).collect()
    assert len(named) == 5 and all(r.cluster_name for r in named) and sum(r.n_properties for r in named) == rows.count()
    holes = ws.features().withColumn("walk_score", F.lit(None).cast("double"))
    assert cluster.assign_clusters(holes, model).filter("cluster is null").count() == 0


def test_silhouette_by_brute_force(spark):
    x, df = points(spark, 150, 2, 5)
    rows = df.select(F.col("id").alias("property_id"), "features", F.col("label").alias("cluster")).filter("id <> 149").unionByName(
        spark.createDataFrame([(500, [50.0, 50.0], 9)], "property_id bigint, features array<double>, cluster int"))
    got = cluster.silhouette(rows).first()
    pdf = rows.toPandas()
    pts, lab = np.stack(pdf.features), pdf.cluster.to_numpy()
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(2))
    s = []
    for i in range(len(pts)):
        same = (lab == lab[i]) & (np.arange(len(pts)) != i)
        if not same.any():
            s.append(0.0)
            continue
        a, b = d[i, same].mean(), min(d[i, lab == c].mean() for c in set(lab) - {lab[i]})
        s.append((b - a) / max(a, b))
    assert got.n == len(pts) and got.silhouette == pytest.approx(np.mean(s), abs=1e-6)


def test_preprocessor_fills_scales_and_encodes(spark):
    df = spark.createDataFrame([(1.0, "b"), (None, "a"), (3.0, None), (5.0, "b")], "x double, c string")
    steps = prepare.build_preprocessor(df, ["x"], ["c"])
    got = [tuple(np.round(r.features.toArray(), 6)) for r in steps.transform(df).collect()]
    assert [g[1] for g in got] == [1, 0, 1, 1] and got[1][0] == got[2][0]
    new = spark.createDataFrame([(3.0, "zzz")], "x double, c string")
    assert steps.transform(new).first().features[1] == -1
    assert sorted(r.c for r in prepare.encode_ordinal(df, ["c"]).collect()) == [-1, 0, 1, 1]


def test_train_compare_store_and_score(ws, spark, tmp_path):
    params = {"random_forest": {"num_trees": 5, "max_depth": 4}, "boosted": {"rounds": 2, "max_depth": 2}}
    table, fitted = classify.train_all(ws.model_table(), ("cart", "random_forest", "boosted", "knn"), False, str(tmp_path), params)
    rows = table.collect()
    assert [r.f1_macro for r in rows] == sorted((r.f1_macro for r in rows), reverse=True) and len(rows) == 4
    assert all(r.roc_auc_ovr is not None and 0 <= r.accuracy <= 1 for r in rows)
    assert classify.best_model(table) == rows[0].model and classify.preferred_model(["cart", "knn"]) == "cart"
    again = models.load_model(spark, f"{tmp_path}/classifier_boosted", PipelineModel)
    out = classify.score_properties(ws.model_table().limit(50), again)
    p = ["p_undervalued", "p_fairly_valued", "p_overvalued"]
    assert out.count() == 50 and out.filter(F.abs(sum(F.col(c) for c in p) - 1) > 0.002).count() == 0
    numeric, categorical = projections.select_features(ws.model_table())
    top = classify.top_importances(fitted["cart"].model, [*numeric, *categorical], spark, 5).collect()
    assert len(top) == 5 and top[0].importance >= top[-1].importance > 0


def test_searches(ws):
    train, test, _ = classify.split_prepared(ws.model_table())
    assert classify.grid_points("cart") == classify.grid_points("cart") and len(classify.grid_points("cart")) == 15
    model, point, score = classify.random_search_cv("cart", train, n=2, folds=2)
    assert set(point) == {"max_depth", "min_leaf", "impurity"} and 0 < score < 1
    point, score = classify.search_knn(train.sample(0.1, 1), n=3, folds=2)
    assert point["k"] in V.SEARCH_SPACE["knn"]["k"] and 0 < score < 1


def test_learning_curve_shape(ws):
    train, _, _ = classify.split_prepared(ws.model_table())
    rows = classify.learning_curve(train, lambda: classify.classify_cart(3), (0.3, 1.0), 2).collect()
    assert [r["size"] for r in rows] == [0.3, 1.0] and all(0 <= r.validation_mean <= 1 for r in rows)


def test_many_requests_are_answered_in_passes(ws, monkeypatch, spark):
    df = ws.features()
    model = recommend.fit_content(df)
    seeds = df.orderBy("property_id").limit(9)
    items = ws.table("part").select(F.col("p_partkey").alias("property_id"))
    buyers = spark.createDataFrame([(i,) for i in range(7)], "buyer_id bigint")
    ask = lambda: (sorted(map(tuple, recommend.recommend_similar(df, seeds, 4, model=model).collect())),
                   sorted(map(tuple, recommend.recommend_for_buyer(items, ws.interactions(), buyers, 4).collect())))
    once = ask()
    monkeypatch.setattr(recommend, "REQUESTS_PER_PASS", 3)
    assert ask() == once and len(once[0]) == 36 and len(once[1]) == 28


def test_ordinal_codes_of_many_values(spark):
    from homespan.operators import prepare

    df = spark.range(12_000).selectExpr("id", "concat('v', lpad(cast(id as string), 6, '0')) as name", "'x' as one")
    coded = prepare.encode_ordinal(df, ["name", "one"])
    assert coded.filter("name != id or one != 0").count() == 0 and coded.count() == 12_000


def test_preference_requests_as_a_table(ws):
    rows = ws.features()
    asked = {f"r{i}": {"budget_max": 20000 + 500 * (i % 90), "prefer_school": i % 2 == 0, "prefer_safe": True} for i in range(300)}
    table = recommend.preference_requests(ws.spark, asked)
    got = recommend.recommend_from_preferences(rows, table, 3).select("request", "rank", "property_id").collect()
    found = {(r.request, r["rank"]): r.property_id for r in got}
    for name in ("r0", "r7", "r299"):
        alone = recommend.recommend_from_preferences(rows, {name: asked[name]}, 3).collect()
        assert {r["rank"]: r.property_id for r in alone} == {k: v for (n, k), v in found.items() if n == name}
        assert all(r.price <= asked[name]["budget_max"] for r in alone)


def test_preference_requests_in_blocks_and_without_wishes(ws, monkeypatch):
    rows = ws.features().limit(500)
    table = recommend.preference_requests(ws.spark, {f"q{i}": {"borough": ["", "asia"][i % 2]} for i in range(20)})
    whole = {tuple(r) for r in recommend.recommend_from_preferences(rows, table, 2).select("request", "rank", "property_id").collect()}
    monkeypatch.setattr(recommend, "REQUESTS_PER_PASS", 4)
    assert {tuple(r) for r in recommend.recommend_from_preferences(rows, table, 2).select("request", "rank", "property_id").collect()} == whole
    assert recommend.recommend_from_preferences(rows, table.limit(0), 2).count() == 0
    bare = recommend.recommend_from_preferences(rows, table.select("request"), 1)
    assert bare.count() == 20


def test_folds_are_stratified(ws):
    rows = classify.with_folds(ws.features().select("property_id", "valuation_label"), 3)
    sizes = {}
    for r in rows.groupBy("valuation_label", "fold").count().collect():
        sizes.setdefault(r.valuation_label, {})[r.fold] = r["count"]
    assert all(set(s) == {0, 1, 2} and max(s.values()) - min(s.values()) <= 2 for s in sizes.values())
