"""Content-based, collaborative and hybrid recommendations.

Many requests are answered in one pass: every task scores its own rows against
the (bounded) request table and hands on only its best rows per request.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from homespan.functions import values as V
from homespan.functions.scalar import clip, round_even
from homespan.operators.filters import REQUEST_FIELDS, asked_for, similarity_filter, within_limits
from homespan.operators.sampling import top_k
from homespan.operators.skew import HOT_ROWS, descending_bucket, group_medians, join_lookup
from homespan.operators.stats import standardize
from homespan.session import cut, fresh_path

REQUESTS_PER_PASS = 2000  # requests scored in one pass over the catalogue
POOL = 200                # candidates that are blended by the hybrid
ALPHA = 0.6


# --- content ---------------------------------------------------------------------

def fit_content(df: DataFrame, features: Sequence[str] = tuple(V.CONTENT_FEATURES),
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """The content model: (feature, median, mean, population deviation), one row per feature."""
    usable = [c for c in features if c in df.columns]
    median = group_medians(df, [], usable, hot_rows=hot_rows).first()  # one number per feature
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(median[c])).alias(c) for c in usable])
    row = filled.agg(F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(c).alias("feature"), F.lit(median[c]).cast("double").alias("median"),
                 F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")) for i, c in enumerate(usable)]).alias("fit"))
    return cut(row.select(F.inline("fit")))


def content_features(df: DataFrame, model: DataFrame) -> DataFrame:
    """Add ``features``: the standardised vector as array<double> (constant columns give 0).

    The model's few numbers become literals of one projection.
    """
    fit = model.orderBy("place").collect()  # one row per feature
    return df.withColumn("features", F.array(*[
        (F.coalesce(F.col(r.feature).cast("double"), F.lit(r.median)) - F.lit(r.mean)) / F.lit(r.std)
        if r.std else F.lit(0.0) for r in fit]))


class _Best:
    """The k best ids of one request so far in a task, ties by id."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, None, None

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if self.ids is not None:
            ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        if len(scores) > self.k:  # every score tied with the k-th stays in until ids decide
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = np.flatnonzero(scores >= edge)
            ids, scores = ids[keep], scores[keep]
        if len(scores) > self.k:
            keep = np.lexsort((ids, -scores))[:self.k]
            ids, scores = ids[keep], scores[keep]
        self.ids, self.scores = ids, scores


def _in_passes(requests: DataFrame, run: Callable[[pd.DataFrame], DataFrame]) -> DataFrame:
    """Answer ``requests`` a bounded block at a time.

    One block is the normal case. More are cut by a hash of the first column;
    each block's answers are stored before the next block is fetched, so the
    driver never holds more than one.
    """
    stored = cut(requests)
    passes = max(1, -(-stored.count() // REQUESTS_PER_PASS))
    if passes == 1:
        return run(stored.toPandas())
    spark, path = requests.sparkSession, fresh_path(requests.sparkSession, "answers")
    for i in range(passes):
        block = stored.filter(F.pmod(F.xxhash64(stored.columns[0]), F.lit(passes)) == i).toPandas()
        run(block).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def similarity_join(catalogue: DataFrame, seeds: DataFrame, k: int, match: str | None = None) -> DataFrame:
    """(seed_id, property_id, similarity): k catalogue rows nearest each seed by cosine, without itself.

    Both sides carry ``property_id``, ``features`` and, if given, the ``match``
    column that must agree. The catalogue streams through the tasks once per
    block of seeds; a task keeps k rows per seed and hands on nothing else.
    """
    schema = f"seed_id string, property_id {dict(catalogue.dtypes)['property_id']}, similarity double"
    columns = ["property_id", "features"] + ([match] if match else [])

    def run(block: pd.DataFrame) -> DataFrame:
        if block.empty:
            return catalogue.limit(0).select(F.lit("").alias("seed_id"), "property_id", F.lit(0.0).alias("similarity"))
        names = block["property_id"].astype(str).to_numpy()
        wanted = block[match].to_numpy() if match else None
        base = np.stack(block["features"].to_numpy()).astype(float)
        base = base / np.maximum(np.linalg.norm(base, axis=1, keepdims=True), 1e-300)

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = [_Best(k) for _ in names]
            for pdf in batches:
                if pdf.empty:
                    continue
                x = np.stack(pdf["features"].to_numpy()).astype(float)
                x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
                sims = np.rint((x @ base.T) * 1e9) / 1e9
                ids = pdf["property_id"].to_numpy()
                text = ids.astype(str)
                for j, seed in enumerate(names):
                    keep = text != seed
                    if match:
                        keep &= pdf[match].to_numpy() == wanted[j]
                    best[j].add(ids[keep], sims[keep, j])
            for seed, b in zip(names, best):
                if b.ids is not None:
                    yield pd.DataFrame({"seed_id": seed, "property_id": b.ids, "similarity": b.scores})
        return catalogue.select(*columns).mapInPandas(score, schema)

    return top_k(_in_passes(seeds.select(*columns), run), ["seed_id"], [F.desc("similarity"), F.asc("property_id")], k)


def recommend_similar(df: DataFrame, seeds: DataFrame, n: int = 10, label: str | None = None,
                      max_price: float | None = None, same_borough: bool = False,
                      model: DataFrame | None = None) -> DataFrame:
    """Top n properties most like each seed row; filters cut the catalogue before scoring."""
    model = model if model is not None else fit_content(df)
    pool = content_features(similarity_filter(df, label, max_price), model)
    return similarity_join(pool, content_features(seeds, model), n, "borough" if same_borough else None)


def preference_score(wish: Callable[[str], Column]) -> Column:
    """Soft score of a request's wishes plus the label bonus; ``wish`` gives a field of the request."""
    parts = {"prefer_walkable": F.col("walk_score") / 100.0, "prefer_safe": 1.0 - F.col("crime_rate_per_1k") / 80.0,
             "prefer_school": F.col("school_quality_score") / 10.0, "prefer_transit": F.col("transit_score") / 100.0}
    score = F.lit(0.0)
    for field, part in parts.items():
        score = score + F.when(asked_for(field, wish(field)), part).otherwise(0.0)
    bonus = F.create_map(*[F.lit(x) for pair in V.LABEL_BONUS.items() for x in pair])
    return round_even(score + F.coalesce(F.try_element_at(bonus, F.col("valuation_label_name")), F.lit(0.0)), 9)


def preference_requests(spark: SparkSession, requests: dict[str, dict]) -> DataFrame:
    """Named requests as a table: request and the fields of ``REQUEST_FIELDS``."""
    rows = [(name, *[wishes.get(f) if wishes.get(f) is None or kind != "double" else float(wishes[f])
                     for f, kind in REQUEST_FIELDS.items()]) for name, wishes in requests.items()]
    return spark.createDataFrame(rows, "request string, " + ", ".join(f"{f} {k}" for f, k in REQUEST_FIELDS.items()))


def recommend_from_preferences(df: DataFrame, requests: DataFrame | dict[str, dict], n: int = 10) -> DataFrame:
    """Top n per request, in one job.

    ``requests`` is a table with a unique ``request`` and any of the fields of ``REQUEST_FIELDS`` (or named requests
    as a dict). The requests are counted and dealt by digest into blocks of about ``REQUESTS_PER_PASS``, each sent to
    all tasks; the catalogue is scanned once a block and only n rows per request and task are shuffled.
    """
    if isinstance(requests, dict):
        requests = preference_requests(df.sparkSession, requests)
    asked = requests.select("request", *[
        (F.col(f) if f in requests.columns else F.lit(None)).cast(kind).alias(f"__{f}") for f, kind in REQUEST_FIELDS.items()])
    blocks = -(-asked.count() // REQUESTS_PER_PASS) or 1

    def wish(field: str) -> Column:
        return F.col(f"__{field}")

    def answered(block: DataFrame) -> DataFrame:
        # about REQUESTS_PER_PASS rows by construction
        return df.join(F.broadcast(block), within_limits(wish)).withColumn("preference_score", preference_score(wish))
    deal = F.pmod(F.xxhash64("request"), F.lit(blocks))
    scored = reduce(DataFrame.unionByName, [answered(asked.filter(deal == b)) for b in range(blocks)])
    return top_k(scored.drop(*[f"__{f}" for f in REQUEST_FIELDS]), ["request"],
                 [F.desc("preference_score"), F.asc("property_id")], n)


# --- buyers' taste ----------------------------------------------------------------

def profile_affinity(df: DataFrame) -> DataFrame:
    """(property_id, buyer_profile, affinity, rating) for the five buyer profiles."""
    used = sorted({c for w in V.BUYER_PROFILES.values() for c in w if c in df.columns})
    z = standardize(df.select("property_id", *used), used)
    scores = []
    for name, weights in V.BUYER_PROFILES.items():
        total = F.lit(0.0)
        for c, w in weights.items():
            if c in used:
                total = total + F.col(f"z_{c}") * w
        scores.append(F.struct(F.lit(name).alias("buyer_profile"), round_even(total, 9).alias("affinity")))
    long = z.select("property_id", F.inline(F.array(*scores)))
    return long.withColumn("rating", clip(F.rint(3.0 + F.col("affinity")), 1.0, 5.0).cast("int"))


def top_affinity(affinity: DataFrame, n: int = 15) -> DataFrame:
    """Best n properties per buyer profile."""
    return top_k(affinity, ["buyer_profile"], [F.desc("affinity"), F.asc("property_id")], n,
                 coarse=descending_bucket(F.col("affinity")))


# --- collaborative -----------------------------------------------------------------

def global_mean(interactions: DataFrame) -> Column:
    return interactions.agg(F.avg("rating").alias("g")).scalar()


def item_means(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("property_id").agg(F.avg("rating").alias("item_mean"))


def buyer_means(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("buyer_id").agg(F.avg("rating").alias("buyer_mean"))


def predict_user_item_mean(pairs: DataFrame, interactions: DataFrame) -> DataFrame:
    """clip(buyer mean + item mean - global mean, 1, 5); an unknown side takes the global mean."""
    g = global_mean(interactions)
    rows = join_lookup(pairs, buyer_means(interactions), ["buyer_id"])
    rows = join_lookup(rows, item_means(interactions), ["property_id"])
    value = F.coalesce("buyer_mean", g) + F.coalesce("item_mean", g) - g
    return rows.withColumn("predicted_rating", round_even(clip(value, 1.0, 5.0), 9)).drop("buyer_mean", "item_mean")


def unseen_items(catalogue: DataFrame, interactions: DataFrame, buyer_id) -> DataFrame:
    """Catalogue ids a buyer has not rated."""
    seen = interactions.filter(F.col("buyer_id") == buyer_id).select("property_id")
    return catalogue.select("property_id").distinct().join(seen, "property_id", "left_anti")


def recommend_for_buyer(catalogue: DataFrame, interactions: DataFrame, buyers: DataFrame, n: int = 10) -> DataFrame:
    """Top n unseen items per requested buyer by predicted rating.

    Each item carries the list of requesting buyers who have rated it; a task
    scores its items for all requests and hands on n rows per buyer.
    """
    id_type, buyer_type = dict(catalogue.dtypes)["property_id"], dict(interactions.dtypes)["buyer_id"]
    schema = f"buyer_id {buyer_type}, property_id {id_type}, predicted_rating double"
    g = global_mean(interactions)
    wanted = buyers.select("buyer_id").distinct()
    profile = join_lookup(wanted, buyer_means(interactions), ["buyer_id"]).select(
        "buyer_id", F.coalesce("buyer_mean", g).alias("u"), g.alias("g"))

    def run(block: pd.DataFrame) -> DataFrame:
        if block.empty:
            return catalogue.limit(0).select(F.lit(None).cast(buyer_type).alias("buyer_id"), "property_id",
                                             F.lit(0.0).alias("predicted_rating"))
        ids, u, mean = block["buyer_id"].tolist(), block["u"].to_numpy(float), float(block["g"].iloc[0])
        place = {b: j for j, b in enumerate(ids)}
        asked = interactions.sparkSession.createDataFrame([(b,) for b in ids], f"buyer_id {buyer_type}")
        seen = interactions.join(F.broadcast(asked), "buyer_id", "left_semi").groupBy("property_id").agg(
            F.collect_set("buyer_id").alias("seen_by"))  # at most one block of buyers
        items = catalogue.select("property_id").distinct() \
            .join(item_means(interactions), "property_id", "left").join(seen, "property_id", "left") \
            .select("property_id", F.coalesce("item_mean", g).alias("m"), "seen_by")

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = [_Best(n) for _ in ids]
            for pdf in batches:
                if pdf.empty:
                    continue
                values = np.clip(pdf["m"].to_numpy()[:, None] + u[None, :] - mean, 1.0, 5.0)
                values = np.rint(values * 1e9) / 1e9
                open_ = np.ones(values.shape, dtype=bool)
                for i, who in enumerate(pdf["seen_by"]):
                    for b in (who if who is not None else ()):
                        open_[i, place[b]] = False
                names = pdf["property_id"].to_numpy()
                for j in range(len(ids)):
                    best[j].add(names[open_[:, j]], values[open_[:, j], j])
            for b, found in zip(ids, best):
                if found.ids is not None:
                    yield pd.DataFrame({"buyer_id": b, "property_id": found.ids, "predicted_rating": found.scores})
        return items.mapInPandas(score, schema)

    return top_k(_in_passes(profile, run), ["buyer_id"], [F.desc("predicted_rating"), F.asc("property_id")], n)


def fit_collaborative(interactions: DataFrame, rank: int = 100, epochs: int = 20, reg: float = 0.02,
                      seed: int = 42) -> tuple[ALSModel, DataFrame]:
    """Factors of what the means leave over: (ALS model, training rows with baseline and residual).

    Needs integer buyer and item ids. The baseline is the buyer and item mean
    prediction before clipping; ALS is Spark's distributed solver.
    """
    g = global_mean(interactions)
    rows = interactions.join(buyer_means(interactions), "buyer_id").join(item_means(interactions), "property_id") \
        .withColumn("baseline", F.col("buyer_mean") + F.col("item_mean") - g) \
        .withColumn("residual", F.col("rating") - F.col("baseline"))
    als = ALS(rank=rank, maxIter=epochs, regParam=reg, userCol="buyer_id", itemCol="property_id",
              ratingCol="residual", coldStartStrategy="nan", seed=seed)
    train = rows.select(F.col("buyer_id").cast("int"), F.col("property_id").cast("int"), "rating", "baseline", "residual")
    return als.fit(train), train


def predict_factors(model: ALSModel, rows: DataFrame) -> DataFrame:
    """clip(baseline + factor product, 1, 5); without factors only the baseline."""
    return model.transform(rows).withColumn("predicted_rating", clip(
        F.col("baseline") + F.when(F.isnan("prediction") | F.col("prediction").isNull(), 0.0)
        .otherwise(F.col("prediction")), 1.0, 5.0))


# --- hybrid ---------------------------------------------------------------------------

def minmax(score: str, request: Sequence[str]) -> Column:
    """0..1 within the request; a constant pool gives 0.5. Pools are at most ``POOL`` rows."""
    w = Window.partitionBy(*request)
    lo, hi = F.min(score).over(w), F.max(score).over(w)
    return F.when(hi - lo < 1e-9, F.lit(0.5)).otherwise((F.col(score) - lo) / F.nullif(hi - lo, F.lit(0.0)))


def blend(pool: DataFrame, request: Sequence[str], content: str, n: int, alpha: float = ALPHA) -> DataFrame:
    """alpha * content + (1 - alpha) * collaborative, both scaled; top n per request."""
    score = alpha * minmax(content, request) + (1.0 - alpha) * minmax("collab_score", request)
    return top_k(pool.withColumn("hybrid_score", round_even(score, 9)), request,
                 [F.desc("hybrid_score"), F.asc("property_id")], n)


def recommend_hybrid(df: DataFrame, interactions: DataFrame, requests: DataFrame, n: int = 10,
                     label: str | None = None, max_price: float | None = None, item: str = "property_id",
                     alpha: float = ALPHA, model: DataFrame | None = None) -> DataFrame:
    """Hybrid list per (buyer_id, property_id of the seed) row of ``requests``.

    ``item`` names the catalogue column that interactions call property_id.
    """
    seeds = join_lookup(df, requests.select("property_id").distinct(), ["property_id"], "left_semi")
    pool = recommend_similar(df, seeds, POOL, label, max_price, model=model).drop("rank")
    asked = requests.select("buyer_id", F.col("property_id").alias("seed_id"))
    pairs = join_lookup(pool, asked, ["seed_id"], "inner")
    return _with_ratings(pairs, df, interactions, item).transform(
        lambda p: blend(p, ["buyer_id", "seed_id"], "similarity", n, alpha))


def recommend_hybrid_preferences(df: DataFrame, interactions: DataFrame, buyer_id,
                                 requests: DataFrame | dict[str, dict],
                                 n: int = 10, item: str = "property_id", alpha: float = ALPHA) -> DataFrame:
    """Hybrid list for one buyer and named preference requests."""
    pool = recommend_from_preferences(df, requests, POOL).select("request", "property_id", "preference_score") \
        .withColumn("buyer_id", F.lit(buyer_id))
    return _with_ratings(pool, df, interactions, item).transform(
        lambda p: blend(p, ["buyer_id", "request"], "preference_score", n, alpha))


def _with_ratings(pool: DataFrame, df: DataFrame, interactions: DataFrame, item: str) -> DataFrame:
    """Attach the mean-mode rating; the pool has at most POOL rows per request."""
    if item == "property_id":
        return predict_user_item_mean(pool, interactions).withColumnRenamed("predicted_rating", "collab_score")
    pool = cut(pool)
    items = join_lookup(df.select("property_id", F.col(item).alias("__item")),
                        pool.select("property_id").distinct(), ["property_id"], "left_semi").distinct()
    keyed = join_lookup(pool, items, ["property_id"], "inner").withColumnsRenamed({"property_id": "__id", "__item": "property_id"})
    scored = predict_user_item_mean(keyed, interactions)
    return scored.drop("property_id").withColumnsRenamed({"__id": "property_id", "predicted_rating": "collab_score"})
