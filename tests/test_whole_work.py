"""Registered training queries do their whole work: all rows, all models, the library's own sizes."""

import inspect

import pytest

from homespan.functions import values as V
from homespan.operators import classify, cluster, neighbours
from homespan.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


class Asked(Exception):
    """Carries what a query asked for, so that a test need not wait for the work itself."""


def asked_of(monkeypatch, module, name, query, spark):
    """All arguments, defaults included, of the first call that a query makes."""
    real = getattr(module, name)

    def stop(*args, **kwargs):
        bound = inspect.signature(real).bind(*args, **kwargs)
        bound.apply_defaults()
        raise Asked(dict(bound.arguments))

    monkeypatch.setattr(module, name, stop)
    with pytest.raises(Asked) as found:
        QUERIES[query](spark, FOLDER)
    return found.value.args[0]


def test_classify_knn_stored_asks_about_every_property(ws, spark, monkeypatch):
    said = asked_of(monkeypatch, neighbours, "classify_stored", "classify_knn_stored", spark)
    assert said["rows"].count() == ws.model_table().count() > 0


def test_classify_random_forest_grows_the_whole_forest(ws, spark, monkeypatch):
    said = asked_of(monkeypatch, classify, "train_one", "classify_random_forest", spark)
    forest = classify.BUILDERS[said["name"]](**said["params"])
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (200, 20)


def test_elbow_scan_fits_every_k_with_restarts_to_the_end(ws, spark, monkeypatch):
    said = asked_of(monkeypatch, cluster, "elbow_scan", "elbow_scan", spark)
    assert (list(said["ks"]), said["rows"], said["restarts"], said["max_iter"]) == (list(range(3, 13)), None, 5, 300)
    fits = []

    class Fit(cluster.KMeans):
        def fit(self, data):
            fits.append((self.getK(), self.getSeed(), self.getMaxIter()))
            return super().fit(data)

    monkeypatch.undo()
    monkeypatch.setattr(cluster, "KMeans", Fit)
    rows = cluster.elbow_scan(ws.features().limit(300), ks=(2, 3), restarts=2, max_iter=7).collect()
    assert [r.k for r in rows] == [2, 3] and fits == [(2, 42, 7), (2, 43, 7), (3, 42, 7), (3, 43, 7)]


def test_fit_kmeans_takes_the_best_of_ten_runs(ws, spark, monkeypatch):
    said = asked_of(monkeypatch, cluster, "fit_kmeans", "fit_kmeans", spark)
    assert (said["k"], said["restarts"], said["max_iter"]) == (8, 10, 300)
    assert list(said["features"]) == V.CLUSTER_FEATURES and said["df"].count() == ws.area_features().count() == ws.features().count()


def test_learning_curve_has_eight_sizes_of_the_whole_tree(ws, spark, monkeypatch):
    said = asked_of(monkeypatch, classify, "learning_curve", "learning_curve", spark)
    assert [round(x, 6) for x in said["sizes"]] == [round(0.1 + 0.9 * i / 7, 6) for i in range(8)] and said["folds"] == 3
    assert said["build"]().getMaxDepth() == 10 and said["train"].count() == ws.model_table().count()


def test_train_all_searches_and_trains_all_four(ws, spark, monkeypatch):
    said = asked_of(monkeypatch, classify, "train_all", "train_all", spark)
    assert list(said["names"]) == ["knn", "cart", "random_forest", "boosted"] and said["tune"] and not said["params"]
    assert said["df"].count() == ws.model_table().count()
    trained = []
    monkeypatch.undo()
    monkeypatch.setattr(classify, "split_prepared", lambda df: (None, None, None))
    monkeypatch.setattr(classify, "train_one", lambda name, train, test, tune, **params: trained.append((name, tune, params)) or
                        classify.Trained(name, None, {"model": name, "f1_macro": float(len(trained))}))
    monkeypatch.setattr(classify.evaluate, "model_comparison", lambda spark, rows: rows)
    assert [r["model"] for r in classify.train_all(ws.model_table())[0]] == ["knn", "cart", "random_forest", "boosted"]
    assert trained == [(name, True, {}) for name in ("knn", "cart", "random_forest", "boosted")]
