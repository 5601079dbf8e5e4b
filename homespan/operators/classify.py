"""Valuation classifiers: training, search, scoring and comparison with Spark ML."""

from __future__ import annotations

import random
import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, keyword_only
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.sql import Column, DataFrame, functions as F

from homespan.functions import values as V
from homespan.functions.scalar import hash_order, hash_uniform, named_label, ratio, round_even
from homespan.operators import evaluate
from homespan.operators.neighbours import knn_join, vote
from homespan.operators.prepare import build_preprocessor, prepared
from homespan.operators.projections import select_features
from homespan.operators.sampling import stratified_split
from homespan.operators.skew import join_lookup, kth_smallest
from homespan.session import fresh_path, short_scans
from homespan.sources.models import save_model
from homespan.sources.tables import write_csv

LABEL = "valuation_label"
CLASSES = sorted(V.LABEL_NAMES)
MAX_DEPTH = 30  # deepest tree Spark grows; stands for "no limit"
BINS = 64
SIDE_BY_SIDE_ROWS = 2_000_000  # largest table that several fits of a search hold at once


def classify_cart(max_depth: int | None = 10, min_leaf: int = 1, impurity: str = "gini", seed: int = 42):
    """Single tree."""
    return DecisionTreeClassifier(
        labelCol=LABEL, featuresCol="features", maxDepth=MAX_DEPTH if max_depth is None else max_depth,
        minInstancesPerNode=min_leaf, impurity=impurity, maxBins=BINS, seed=seed)


def classify_random_forest(num_trees: int = 200, max_depth: int | None = 20, features: str = "sqrt", seed: int = 42):
    """Forest of trees over random feature subsets.

    Rows find their nodes by walking the trees: a stored number per row, tree and level would fill the disks.
    """
    return RandomForestClassifier(
        labelCol=LABEL, featuresCol="features", numTrees=num_trees, featureSubsetStrategy=features,
        maxDepth=MAX_DEPTH if max_depth is None else max_depth, maxBins=BINS, seed=seed, cacheNodeIds=False,
        maxMemoryInMB=512)


def classify_boosted(rounds: int = 200, max_depth: int = 6, step: float = 0.1, subsample: float = 0.85,
                     features: str = "0.85", seed: int = 42):
    """Gradient boosting, one binary model per class.

    The classes are fitted one after the other: each fit holds its own binned copy of the rows, and the shallow trees
    find a row's node faster than a stored node number per row and level is kept.
    """
    return OneVsRest(labelCol=LABEL, featuresCol="features", parallelism=1, classifier=GBTClassifier(
        maxIter=rounds, maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
        featureSubsetStrategy=features, maxBins=BINS, seed=seed))


BUILDERS = {"cart": classify_cart, "random_forest": classify_random_forest, "boosted": classify_boosted}


def class_probabilities(scored: DataFrame) -> Column:
    """Class probabilities as array<double>; one-vs-rest margins are squashed and scaled to sum to one."""
    if "probability" in scored.columns:
        return vector_to_array("probability")
    odds = F.transform(vector_to_array("rawPrediction"), lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
    total = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    return F.transform(odds, lambda x: x / total)


def predict(model, rows: DataFrame) -> DataFrame:
    """Add ``prediction`` (int) and ``probabilities``."""
    scored = model.transform(rows)
    return scored.withColumns({"prediction": F.col("prediction").cast("int"),
                               "probabilities": class_probabilities(scored)})


class MacroF1(Evaluator):
    """Unweighted mean F1 over the classes (Spark's own ``f1`` weights by class size)."""

    label = Param(Params._dummy(), "label", "label column")

    @keyword_only
    def __init__(self, label: str = LABEL):
        super().__init__()
        self._set(label=label)

    def _evaluate(self, dataset: DataFrame) -> float:
        row = evaluate.classifier_metrics(dataset, self.getOrDefault(self.label), "prediction").first()
        return float(row.f1_macro or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def grid_points(name: str, n: int | None = None, seed: int = 42) -> list[dict]:
    """n distinct points of a model's search space, the same for the same seed."""
    space = V.SEARCH_SPACE[name]
    points = [dict(zip(space, combo)) for combo in product(*space.values())]
    return random.Random(seed).sample(points, min(n or V.SEARCH_POINTS[name], len(points)))


def with_folds(df: DataFrame, folds: int = 3, key: str = "property_id", label: str = LABEL) -> DataFrame:
    """Stratified ``fold`` numbers: per label, the key digests are cut at equal counts.

    Only folds - 1 cutoffs per label are computed. Rows without a label are in fold 0.
    """
    out, fold = df.withColumn("__order", hash_order(key)), F.lit(0)
    marked = out.filter(F.col(label).isNotNull())
    for i in range(1, folds):
        cutoffs = kth_smallest(marked, [label], "__order", lambda total, i=i: F.ceil(total * i / folds)) \
            .withColumnRenamed("cutoff", f"__cut_{i}")
        out = join_lookup(out, cutoffs, [label])
        fold = fold + F.coalesce((F.col("__order") > F.col(f"__cut_{i}")).cast("int"), F.lit(0))
    return out.withColumn("fold", fold).drop("__order", *[f"__cut_{i}" for i in range(1, folds)])


def random_search_cv(name: str, train: DataFrame, n: int | None = None, folds: int = 3, seed: int = 42,
                     parallelism: int | None = None):
    """(best model refitted on all rows, its parameters, its mean macro F1) of a random search.

    The rows are kept on disk once with their folds. Every fit holds its own binned copy of them, so fits run side by
    side only over tables that leave the cluster idle (up to ``SIDE_BY_SIDE_ROWS``); larger ones use it all one by one.
    """
    points = grid_points(name, n, seed)
    rows = with_folds(train, folds).persist(StorageLevel.DISK_ONLY)

    def score(job: tuple[dict, int]) -> float:
        point, f = job
        model = BUILDERS[name](**point, seed=seed).fit(rows.filter(F.col("fold") != f))
        return MacroF1().evaluate(model.transform(rows.filter(F.col("fold") == f)))
    with short_scans(train.sparkSession):
        size = rows.count()
        side_by_side = parallelism or (4 if size <= SIDE_BY_SIDE_ROWS else 1)
        with ThreadPool(side_by_side) as pool:
            scores = pool.map(score, [(point, f) for point in points for f in range(folds)], 1)
        rows.unpersist()
        means = [sum(scores[i * folds: (i + 1) * folds]) / folds for i in range(len(points))]
        i = max(range(len(points)), key=lambda j: (means[j], -j))
        return BUILDERS[name](**points[i], seed=seed).fit(train), points[i], means[i]


def search_knn(train: DataFrame, n: int | None = None, folds: int = 3, seed: int = 42) -> tuple[dict, float]:
    """Random search for the neighbour vote: one join per (fold, p) serves every k and weighting."""
    points = grid_points("knn", n, seed)
    rows = with_folds(train.withColumnRenamed("property_id", "id").withColumnRenamed(LABEL, "label"), folds, "id", "label")
    scores: dict[int, list[float]] = {i: [] for i in range(len(points))}
    for p in sorted({pt["p"] for pt in points}):
        widest = max(pt["k"] for pt in points if pt["p"] == p)
        for f in range(folds):
            test = rows.filter(F.col("fold") == f)
            found = knn_join(test, rows.filter(F.col("fold") != f), widest, p)
            path = fresh_path(train.sparkSession, "knn-search")
            found.write.parquet(path)
            found = train.sparkSession.read.parquet(path)
            for i, pt in enumerate(points):
                if pt["p"] == p:
                    called = vote(found, pt["weights"], pt["k"]).join(
                        test.select(F.col("id").alias("test_id"), F.col("label").alias("actual")), "test_id")
                    scores[i].append(float(evaluate.classifier_metrics(called, "actual", "prediction").first().f1_macro))
    means = {i: sum(s) / len(s) for i, s in scores.items()}
    i = max(means, key=lambda j: (means[j], -j))
    return points[i], means[i]


@dataclass
class Trained:
    """A fitted classifier with its evaluation."""

    name: str
    model: object
    metrics: dict
    params: dict = field(default_factory=dict)


def split_prepared(df: DataFrame) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """(train, test, preprocessor): vectors stored once for every model; fitted on the training rows only."""
    spark = df.sparkSession
    numeric, categorical = select_features(df)
    split, ready = fresh_path(spark, "split"), fresh_path(spark, "prepared")
    stratified_split(df.select("property_id", LABEL, *numeric, *categorical), LABEL) \
        .write.option("compression", "zstd").parquet(split)
    marked = spark.read.parquet(split)  # several fitting passes read only what they need
    steps = build_preprocessor(marked.filter(~F.col("is_test")), numeric, categorical)
    prepared(marked, steps, ["property_id", LABEL, "is_test"]).write.option("compression", "zstd").parquet(ready)
    rows = spark.read.parquet(ready)
    # the reader loses nothing the trees need: codes are plain numbers
    return rows.filter(~F.col("is_test")).drop("is_test"), rows.filter("is_test").drop("is_test"), steps


def summarise(scored: DataFrame, actual: str = LABEL) -> dict:
    """All summary metrics of scored rows (``prediction``, ``probabilities``)."""
    out = evaluate.classifier_metrics(scored, actual, "prediction").first().asDict()
    auc = evaluate.roc_auc_ovr(scored, actual, {c: F.get("probabilities", F.lit(c)) for c in CLASSES})
    row = auc.filter(F.col("class") == -1).first()
    return {**out, "roc_auc_ovr": row.auc if row else None}


def train_one(name: str, train: DataFrame, test: DataFrame, tune: bool = True, **params) -> Trained:
    """Fit (or search) one classifier and evaluate it on the test rows."""
    start = time.perf_counter()
    if name == "knn":
        best = search_knn(train)[0] if tune else {"k": 5, "weights": "distance", "p": 2, **params}
        trained = time.perf_counter()
        ids = [F.col("property_id").alias("id"), "features"]
        found = knn_join(test.select(*ids), train.select(*ids, F.col(LABEL).alias("label")), best["k"], best["p"])
        shares = [F.coalesce(F.try_element_at("shares", F.lit(c)), F.lit(0.0)) for c in CLASSES]
        scored = vote(found, best["weights"]).join(
            test.select(F.col("property_id").alias("test_id"), LABEL), "test_id").withColumn("probabilities", F.array(*shares))
        model = best
    else:
        if tune:
            model, best, _ = random_search_cv(name, train)
        else:
            with short_scans(train.sparkSession):
                model, best = BUILDERS[name](**params).fit(train), params
        trained = time.perf_counter()
        scored = predict(model, test)
    path = fresh_path(train.sparkSession, f"scored-{name}")
    scored.select(LABEL, "prediction", "probabilities").write.parquet(path)
    done = time.perf_counter()
    metrics = summarise(train.sparkSession.read.parquet(path))
    return Trained(name, model, {"model": name, **metrics, "train_sec": trained - start, "predict_sec": done - trained}, best)


def train_all(df: DataFrame, names: Sequence[str] = ("knn", "cart", "random_forest", "boosted"), tune: bool = True,
              folder: str | None = None, params: dict[str, dict] | None = None) -> tuple[DataFrame, dict[str, Trained]]:
    """(comparison table, fitted models); with ``folder`` models and table are stored there."""
    train, test, steps = split_prepared(df)
    fitted = {n: train_one(n, train, test, tune, **(params or {}).get(n, {})) for n in names}
    comparison = evaluate.model_comparison(df.sparkSession, [t.metrics for t in fitted.values()])
    if folder:
        write_csv(comparison, f"{folder}/classifier_comparison")
        for name, t in fitted.items():
            if name == "knn":  # a neighbour model is its training table and parameters
                save_model(train.select("property_id", LABEL, "features"), f"{folder}/classifier_knn")
            else:
                save_model(PipelineModel([*steps.stages, t.model]), f"{folder}/classifier_{name}")
    return comparison, fitted


def best_model(comparison: DataFrame) -> str:
    """Name of the model with the best macro F1."""
    return evaluate.rank_models(comparison).first().model


def preferred_model(names: Sequence[str]) -> str:
    """The most trusted kind among those available."""
    for name in V.MODEL_PREFERENCE:
        if name in names:
            return name
    raise LookupError("no trained classifier found")


def score_properties(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Label, three probabilities (three decimals) and implied price per square foot per row."""
    scored = predict(model, rows)
    out = scored.withColumn("predicted_label", named_label("prediction", V.LABEL_NAMES)).withColumns({
        f"p_{name}": round_even(F.get("probabilities", F.lit(c)), 3) for c, name in V.LABEL_NAMES.items()})
    if "implied_ppsf" not in out.columns:
        out = out.withColumn("implied_ppsf", round_even(ratio("price", "sqft"), 2))
    return out.select(*[c for c in rows.columns if c != "implied_ppsf"], "implied_ppsf", "predicted_label",
                      *[f"p_{name}" for name in V.LABEL_NAMES.values()])


def feature_importance(model, names: Sequence[str], spark) -> DataFrame:
    """(feature, importance) of a tree model; one-vs-rest gives the mean over its models."""
    trees = model.models if hasattr(model, "models") else [model]
    mean = [sum(float(t.featureImportances[i]) for t in trees) / len(trees) for i in range(len(names))]
    return spark.createDataFrame(list(zip(names, mean)), "feature string, importance double")


def top_importances(model, names: Sequence[str], spark, n: int = 20) -> DataFrame:
    """The n most important features."""
    return feature_importance(model, names, spark).orderBy(F.desc("importance"), "feature").limit(n)


def learning_curve(train: DataFrame, build, sizes: Sequence[float] = tuple(0.1 + 0.9 * i / 7 for i in range(8)),
                   folds: int = 3) -> DataFrame:
    """(size, train and validation macro F1: mean and deviation) over growing nested samples."""
    drawn = with_folds(train, folds).withColumn("draw", hash_uniform("property_id", "draw"))  # independent of the folds
    rows = drawn.persist(StorageLevel.DISK_ONLY)  # digests are taken once, not by each fit
    judge, out = MacroF1(), []
    for size in sizes:
        part = rows.filter(F.col("draw") < size) if size < 1.0 else rows
        seen, unseen = [], []
        for f in range(folds):
            used = part.filter(F.col("fold") != f)
            with short_scans(train.sparkSession):
                model = build().fit(used)
            seen.append(judge.evaluate(model.transform(used)))
            unseen.append(judge.evaluate(model.transform(rows.filter(F.col("fold") == f))))
        out.append((float(size), *_mean_std(seen), *_mean_std(unseen)))
    rows.unpersist()
    return train.sparkSession.createDataFrame(
        out, "size double, train_mean double, train_std double, validation_mean double, validation_std double")


def _mean_std(x: list[float]) -> tuple[float, float]:
    m = sum(x) / len(x)
    return m, (sum((v - m) ** 2 for v in x) / len(x)) ** 0.5
