"""Classifier and recommender metrics, computed from small count tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from homespan.functions.scalar import round_even
from homespan.operators.skew import running_totals
from homespan.sources.tables import COMPARISON_SCHEMA

SUMMARY_METRICS = ["accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro", "roc_auc_ovr",
                   "cohen_kappa"]


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, n): everything below works on this small table."""
    return df.groupBy(F.col(actual).cast("int").alias("actual"), F.col(predicted).cast("int").alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, classes: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """One row per actual class, one count column per predicted class."""
    counts = confusion_counts(df, actual, predicted)
    wide = counts.groupBy("actual").pivot("predicted", list(classes)).agg(F.sum("n"))
    return wide.select("actual", *[F.coalesce(F.col(str(c)), F.lit(0)).alias(f"predicted_{c}") for c in classes])


def _per_class(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support for every class seen on either side."""
    sides = counts.select(F.explode(F.array(
        F.struct(F.col("actual").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("predicted").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called"),
                 F.lit(0).cast("bigint").alias("hit")))).alias("s")).select("s.*")
    by = sides.groupBy(F.col("c").alias("class")).agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit"))
    zero = F.lit(0.0)
    p = F.coalesce(F.try_divide(F.col("hit").cast("double"), F.col("called")), zero)
    r = F.coalesce(F.try_divide(F.col("hit").cast("double"), F.col("support")), zero)
    return by.withColumns({"precision": p, "recall": r}).withColumn("f1", F.coalesce(F.try_divide(
        2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero))


def classifier_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy, macro and weighted F1, macro precision and recall, Cohen's kappa (one row)."""
    per = _per_class(confusion_counts(df, actual, predicted))
    n = F.sum("support").cast("double")
    row = per.agg(
        (F.sum("hit") / n).alias("accuracy"), F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
        (F.sum(F.col("support").cast("double") * F.col("called")) / (n * n)).alias("chance"))
    kappa = F.try_divide(F.col("accuracy") - F.col("chance"), 1.0 - F.col("chance"))
    return row.withColumn("cohen_kappa", kappa).select(*[
        round_even(m, 6).alias(m) for m in SUMMARY_METRICS if m != "roc_auc_ovr"])


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per-class rows plus accuracy, macro and weighted averages."""
    per = _per_class(confusion_counts(df, actual, predicted))
    rows = per.select(F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support")
    n = F.sum("support").cast("double")
    total = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("row"), *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")],
                    total.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("row"), *[
        (F.sum(F.col(m) * F.col("support")) / n).alias(m) for m in ("precision", "recall", "f1")],
        total.alias("support"))
    hit = per.agg(F.lit("accuracy").alias("row"), *[
        (F.sum("hit") / n).alias(m) for m in ("precision", "recall", "f1")], total.alias("support"))
    return rows.unionByName(hit).unionByName(macro).unionByName(weighted).withColumns(
        {m: round_even(m, 6) for m in ("precision", "recall", "f1")})


def _score_cells(df: DataFrame, actual: str, scores: dict[int, Column]) -> DataFrame:
    """(class, score, pos, neg): rows counted per distinct score before any ordering."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("class"), s.cast("double").alias("score"),
                 (F.col(actual) == c).cast("bigint").alias("pos"), (F.col(actual) != c).cast("bigint").alias("neg"))
        for c, s in scores.items()])))
    return long.groupBy("class", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def roc_auc_ovr(df: DataFrame, actual: str, scores: dict[int, Column]) -> DataFrame:
    """Exact one-vs-rest AUC per class and weighted by class size (row -1).

    Ties count half. Scores are counted, then ordered in value buckets, so no
    task sorts a whole class. A class without both outcomes has no AUC.
    """
    cells = running_totals(_score_cells(df, actual, scores), ["class"], "score", ["pos", "neg"])
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    by = cells.groupBy("class").agg(won.alias("won"), F.max("pos_total").alias("p"), F.max("neg_total").alias("n"))
    auc = by.select("class", F.try_divide("won", F.col("p").cast("double") * F.col("n")).alias("auc"),
                    F.col("p").alias("positives"))
    none = F.count_if(F.col("auc").isNull()) > 0
    mean = auc.agg(F.lit(-1).alias("class"), F.when(~none, F.try_divide(
        F.sum(F.col("auc") * F.col("positives")), F.sum("positives").cast("double"))).alias("auc"),
        F.sum("positives").alias("positives"))
    return auc.unionByName(mean).withColumn("auc", round_even("auc", 6))


def roc_curve(df: DataFrame, actual: str, scores: dict[int, Column]) -> DataFrame:
    """(class, threshold, fpr, tpr) at every distinct score, highest first, plus the origin."""
    cells = running_totals(_score_cells(df, actual, scores), ["class"], "score", ["pos", "neg"], descending=True)
    points = cells.select(
        "class", F.col("score").alias("threshold"),
        F.try_divide((F.col("neg_before") + F.col("neg")).cast("double"), F.col("neg_total")).alias("fpr"),
        F.try_divide((F.col("pos_before") + F.col("pos")).cast("double"), F.col("pos_total")).alias("tpr"))
    origin = points.select("class").distinct().select("class", F.lit(float("inf")).alias("threshold"),
                                                      F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin).withColumns({c: round_even(c, 6) for c in ("fpr", "tpr")})


def model_comparison(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """Summary rows of evaluated models, best macro F1 first."""
    names = [part.split()[0] for part in COMPARISON_SCHEMA.split(", ")]
    places = {"train_sec": 2, "predict_sec": 3}
    data = [tuple(r["model"] if n == "model" else None if r.get(n) is None else float(r[n]) for n in names) for r in rows]
    table = spark.createDataFrame(data, COMPARISON_SCHEMA)
    return rank_models(table.withColumns({n: round_even(n, places.get(n, 4)) for n in names[1:]}))


def rank_models(comparison: DataFrame) -> DataFrame:
    """Best macro F1 first."""
    return comparison.orderBy(F.desc("f1_macro"), "model")


def recommender_metrics(recommended: DataFrame, relevant: DataFrame, ks: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """precision, recall and NDCG at each k per request.

    ``recommended``: (request, rank from 1, property_id), ranked lists of bounded
    length; ``relevant``: (property_id). With nothing relevant all are 0.
    """
    wanted = relevant.select("property_id").distinct().withColumn("hit", F.lit(1))
    marked = recommended.join(wanted, "property_id", "left")
    total = relevant.agg(F.count_distinct("property_id").alias("n")).scalar()
    at = F.explode(F.array(*[F.lit(k) for k in ks]))
    top = marked.withColumn("k", at).withColumn("use", F.col("rank") <= F.col("k"))
    gain = F.when(F.col("use") & F.col("hit").isNotNull(), 1.0 / F.log2(F.col("rank") + 1.0))
    by = top.groupBy("request", "k").agg(
        F.count_if(F.col("use") & F.col("hit").isNotNull()).alias("hits"), F.coalesce(F.sum(gain), F.lit(0.0)).alias("dcg"))
    by = by.withColumn("relevant", total)
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("k").cast("bigint"), F.col("relevant")).cast("int")),
                        F.lit(0.0), lambda s, i: s + 1.0 / F.log2(i + 1.0))
    some = F.col("relevant") > 0
    return by.select(
        "request", "k", round_even(F.col("hits") / F.col("k"), 6).alias("precision"),
        round_even(F.when(some, F.col("hits") / F.nullif("relevant", F.lit(0))).otherwise(0.0), 6).alias("recall"),
        round_even(F.when(some, F.col("dcg") / ideal).otherwise(0.0), 6).alias("ndcg"))


def catalog_coverage(recommended: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Share of the catalogue that was recommended (one row)."""
    size = catalogue.agg(F.count(F.lit(1)).alias("n")).scalar()
    return recommended.agg(F.count_distinct("property_id").alias("recommended")).select(
        "recommended", size.alias("catalogue"),
        round_even(F.try_divide(F.col("recommended").cast("double"), size), 6).alias("coverage"))
