"""Exact k-nearest-neighbour join and vote.

Training rows are split into cells around pivots and the cells into blocks of
bounded size. Distances to the pivots bound how far a test row's k-th neighbour
can be, so each test row visits only the cells that may hold one of its
neighbours (triangle inequality, valid for p = 1 and p = 2). No task sees more
than one block of training rows and one chunk of test rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from homespan.functions.scalar import hash_uniform, settle
from homespan.operators.sampling import sample_n, top_k
from homespan.session import cut

BLOCK_ROWS = 50_000   # training rows in one block
CHUNK_ROWS = 50_000   # test rows that visit a block in one task
MAX_PIVOTS = 512
SLICE, TILE = 256, 4_096  # test rows by training rows compared at once: their distances stay in the processor's cache
PAIRS = 250_000       # pairs whose exact distances are taken at once
SLACK = 1e-9


def _distances(x: np.ndarray, y: np.ndarray, p: int) -> np.ndarray:
    """Exact Minkowski distances (rows of x by rows of y), in slices of bounded size."""
    out = np.empty((len(x), len(y)))
    step = max(1, 4_000_000 // max(1, len(y) * x.shape[1]))
    for i in range(0, len(x), step):
        gap = np.abs(x[i:i + step, None, :] - y[None, :, :])
        out[i:i + step] = gap.sum(2) if p == 1 else np.sqrt((gap * gap).sum(2))
    return out


def _rough(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(a, b, slack): a @ b is the squared distance of every row of x to every row of y less the row's own square, off by
    at most the slack; single precision unless a few far rows would make that too coarse."""
    whole = y[np.isfinite(y).all(1)]
    centre = whole.mean(0) if len(whole) else np.zeros(y.shape[1])
    x, y = x - centre, y - centre
    squares = (y * y).sum(1)
    sizes = np.concatenate([(x * x).sum(1), squares])
    sizes = sizes[np.isfinite(sizes)]
    largest, middle = (float(sizes.max()), float(np.median(sizes))) if len(sizes) else (1.0, 1.0)
    kind = np.float32 if 0 < largest <= 50 * middle < 1e30 else np.float64
    a = np.hstack([-2.0 * x, np.ones((len(x), 1))]).astype(kind)
    b = np.ascontiguousarray(np.vstack([y.T, squares]), dtype=kind)
    return a, b, max(8.0 * (x.shape[1] + 8) * float(np.finfo(kind).eps), 1e-9) * max(largest, 1e-9)


def _nearest(x: np.ndarray, y: np.ndarray, order: np.ndarray, k: int, p: int,
             allowed: Callable[[int, int], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of x, positions in y, distances to nine places) of each row's k nearest, ties by ``order``, row by row.

    Cheap distances, a tile at a time, choose candidates; exact ones rank them. ``allowed(start, end)`` may restrict the
    pairs by a boolean matrix (rows start to end of x by rows of y).
    """
    if p == 2:
        a, b, slack = _rough(x, y)
    else:
        slack = 1e-9 * max(1.0, float(np.nanmax(np.abs(y), initial=0.0)))

    def best(rows: list[np.ndarray], at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r, c = np.concatenate(rows), np.concatenate(at)
        d = np.empty(len(r))
        for i in range(0, len(r), PAIRS):
            gap = np.abs(x[r[i:i + PAIRS]] - y[c[i:i + PAIRS]])
            d[i:i + PAIRS] = gap.sum(1) if p == 1 else np.sqrt((gap * gap).sum(1))
        d = np.rint(d * 1e9) / 1e9
        by = np.lexsort((order[c], d, r))
        r, c, d = r[by], c[by], d[by]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < k
        return r[keep], c[keep], d[keep]

    tile = max(TILE, 4 * k)
    for i in range(0, len(x), SLICE):
        end = min(i + SLICE, len(x))
        may = allowed(i, end) if allowed else None
        if may is not None and np.count_nonzero(may) * 50 < may.size:  # too few pairs for tiles to pay
            r, c = np.divmod(np.flatnonzero(may), len(y))
            yield best([r + i], [c])
            continue
        edge, rows, at = None, [], []
        for j in range(0, len(y), tile):
            rough = a[i:end] @ b[:, j:j + tile] if p == 2 else _distances(x[i:end], y[j:j + tile], 1)
            if may is not None:
                rough = np.where(may[:, j:j + tile], rough, np.nan)  # nan is never within an edge
            if edge is None:
                edge = np.partition(rough, k - 1, axis=1)[:, k - 1:k] + slack if rough.shape[1] > k else np.full((end - i, 1), np.inf)
                edge = np.where(np.isnan(edge), np.inf, edge)
            r, c = np.divmod(np.flatnonzero(rough <= edge), rough.shape[1])
            rows.append(r + i)
            at.append(c + j)
            if sum(map(len, rows)) > 4 * PAIRS:  # many ties
                r, c, _ = best(rows, at)
                rows, at = [r], [c]
        yield best(rows, at)


def _found(asked: pd.DataFrame, block: pd.DataFrame, k: int, p: int,
           allowed: Callable[[np.ndarray, np.ndarray], Callable] | None = None) -> pd.DataFrame:
    """(test_id, train_id, label, distance): the k nearest rows of a block to each asked row (test_id, features)."""
    columns = ["test_id", "train_id", "label", "distance"]
    if asked.empty or block.empty:
        return pd.DataFrame(columns=columns)
    x, y = (np.stack(f["features"].to_numpy()).astype(float) for f in (asked, block))
    order = pd.factorize(block["id"], sort=True)[0]  # a missing id comes first
    parts = list(_nearest(x, y, order, k, p, allowed(x, y) if allowed else None))
    rows, at, d = (np.concatenate(part) for part in zip(*parts))
    return pd.DataFrame({"test_id": asked["test_id"].to_numpy()[rows], "train_id": block["id"].to_numpy()[at],
                         "label": block["label"].to_numpy()[at], "distance": d})


def _arrays(df: DataFrame) -> DataFrame:
    """``features`` as array<double>, whether they come as an array or an ML vector."""
    if isinstance(df.schema["features"].dataType, T.ArrayType):
        return df.withColumn("features", F.col("features").cast("array<double>"))
    return df.withColumn("features", vector_to_array("features"))


@dataclass
class MetricIndex:
    """Training rows placed in cells around pivots, split into blocks: a k-NN model that can be stored.

    ``rows``: id, features, label, cell, away (distance to its pivot), part (block within the cell); ``pivots``: one
    row of features per pivot; ``cells``: cell, n, lo, hi (least and largest ``away``), heads (the k smallest), parts.
    Pivots and cells hold at most MAX_PIVOTS rows; ``preprocessor`` turns raw rows into ``features`` when set.
    """

    rows: DataFrame
    pivots: np.ndarray
    cells: pd.DataFrame
    k: int
    p: int
    preprocessor: object = None


def build_index(train: DataFrame, k: int = 5, p: int = 2, block_rows: int = BLOCK_ROWS) -> MetricIndex:
    """Place ``train`` (id, features, label) in cells around sampled pivots; bounds for searches of up to k."""
    if p not in (1, 2):
        raise ValueError("p must be 1 or 2")
    train = _arrays(train)
    spark = train.sparkSession
    id_type, label_type = dict(train.dtypes)["id"], dict(train.dtypes)["label"]
    n_train = train.count()
    m = max(1, min(MAX_PIVOTS, math.ceil(n_train / block_rows) * 2))
    chosen = sample_n(train.select("id", "features"), m, "id").toPandas()  # at most MAX_PIVOTS rows
    centres = np.stack(chosen["features"].to_numpy()).astype(float) if len(chosen) else np.zeros((0, 0))
    pivots = spark.sparkContext.broadcast(centres)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            d = _distances(np.stack(pdf["features"].to_numpy()).astype(float), pivots.value, p)
            cell = d.argmin(1)
            yield pdf.assign(cell=cell.astype(np.int32), away=d[np.arange(len(cell)), cell])

    placed = cut(train.select("id", "features", "label").mapInPandas(
        place, f"id {id_type}, features array<double>, label {label_type}, cell int, away double"))
    # per cell: size, nearest and farthest row, and the distances of the k rows nearest its pivot
    edges = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("lo"), F.max("away").alias("hi"))
    heads = top_k(placed.select("cell", "away", "id"), ["cell"], [F.asc("away"), F.asc("id")], k).groupBy("cell").agg(
        F.sort_array(F.collect_list("away")).alias("heads"))
    cells = edges.join(heads, "cell").orderBy("cell").toPandas()  # at most MAX_PIVOTS rows of k numbers
    cells["parts"] = [max(1, math.ceil(n / block_rows)) for n in cells["n"]]
    split = F.create_map(*[F.lit(v) for c, n in zip(cells["cell"], cells["parts"]) for v in (int(c), int(n))]) \
        if len(cells) else F.create_map().cast("map<int,int>")
    rows = placed.withColumn("part", F.floor(hash_uniform("id", "part") * F.element_at(split, F.col("cell"))).cast("int"))
    return MetricIndex(rows, centres, cells, k, p)


def save_index(index: MetricIndex, path: str) -> None:
    """Rows as parquet, pivots, cells and parameters as small parquet tables, the preprocessor by its own writer."""
    spark = index.rows.sparkSession
    index.rows.write.mode("overwrite").parquet(f"{path}/rows")
    pivots = pd.DataFrame({"pivot": range(len(index.pivots)), "features": [r.tolist() for r in index.pivots]})
    spark.createDataFrame(pivots, "pivot int, features array<double>").write.mode("overwrite").parquet(f"{path}/pivots")
    spark.createDataFrame(index.cells[["cell", "n", "lo", "hi", "heads", "parts"]], "cell int, n long, lo double, hi double, heads array<double>, parts int") \
        .write.mode("overwrite").parquet(f"{path}/cells")
    spark.createDataFrame([(index.k, index.p, index.preprocessor is not None)], "k int, p int, prepared boolean") \
        .write.mode("overwrite").parquet(f"{path}/params")
    if index.preprocessor is not None:
        index.preprocessor.write().overwrite().save(f"{path}/preprocessor")


def load_index(spark, path: str) -> MetricIndex:
    """Inverse of ``save_index``; only the small tables come to the driver."""
    params = spark.read.parquet(f"{path}/params").first()
    pivots = spark.read.parquet(f"{path}/pivots").orderBy("pivot").toPandas()  # at most MAX_PIVOTS rows
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").toPandas()
    cells["heads"] = cells["heads"].map(list)
    centres = np.stack(pivots["features"].to_numpy()).astype(float) if len(pivots) else np.zeros((0, 0))
    preprocessor = None
    if params.prepared:
        from pyspark.ml import PipelineModel

        preprocessor = PipelineModel.load(f"{path}/preprocessor")
    return MetricIndex(spark.read.parquet(f"{path}/rows"), centres, cells, params.k, params.p, preprocessor)


def search_index(index: MetricIndex, test: DataFrame, k: int | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(test_id, train_id, label, distance, rank): the k (at most the index's k) nearest rows of each test row
    (id, features). Ties by id."""
    k = k or index.k
    if k > index.k:
        raise ValueError(f"the index bounds searches of up to {index.k} neighbours")
    p, placed, cells = index.p, index.rows, index.cells
    test = _arrays(test)
    spark = placed.sparkSession
    id_type, label_type = dict(placed.dtypes)["id"], dict(placed.dtypes)["label"]
    test_type = dict(test.dtypes)["id"]
    if not len(cells):  # an empty index: no neighbours for anyone
        return test.limit(0).select(F.col("id").alias("test_id"), F.lit(None).cast(id_type).alias("train_id"),
                                    F.lit(None).cast(label_type).alias("label"), F.lit(0.0).alias("distance"),
                                    F.lit(0).alias("rank"))
    pivots = spark.sparkContext.broadcast(index.pivots)
    shared = spark.sparkContext.broadcast((
        cells["cell"].to_numpy(), cells["lo"].to_numpy(), cells["hi"].to_numpy(),
        np.array([h for hs in cells["heads"] for h in hs]), np.array([i for i, hs in enumerate(cells["heads"]) for _ in hs])))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, lo, hi, near, owner = shared.value
        for pdf in batches:
            for start in range(0, len(pdf), 500):
                rows = pdf.iloc[start:start + 500]
                x = np.stack(rows["features"].to_numpy()).astype(float)
                d = _distances(x, pivots.value, p)
                own = d.min(1)
                d = d[:, number]
                reach = d[:, owner] + near[None, :]
                kth = min(k, reach.shape[1]) - 1
                bound = np.partition(reach, kth, axis=1)[:, kth] if reach.shape[1] >= k else np.full(len(x), np.inf)
                least = np.maximum(np.maximum(d - hi, lo - d), (d - own[:, None]) / 2.0)
                visits = least <= bound[:, None] * (1 + SLACK) + SLACK
                yield pd.DataFrame({"test_id": rows["id"].to_numpy(), "features": list(x),
                                    "cells": [number[v].tolist() for v in visits]})

    split = F.create_map(*[F.lit(v) for c, n in zip(cells["cell"], cells["parts"]) for v in (int(c), int(n))]) \
        if len(cells) else None
    visits = cut(test.select("id", "features").mapInPandas(
        route, f"test_id {test_type}, features array<double>, cells array<int>"))
    routed = visits.select("test_id", "features", F.explode("cells").alias("cell"))
    load = {r.cell: max(1, math.ceil(r.n / chunk_rows)) for r in routed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # at most MAX_PIVOTS rows
    if not load or split is None:
        return visits.limit(0).select("test_id", F.lit(None).cast(id_type).alias("train_id"),
                                      F.lit(None).cast(label_type).alias("label"), F.lit(0.0).alias("distance"),
                                      F.lit(0).alias("rank"))
    chunks = F.create_map(*[F.lit(v) for c, n in load.items() for v in (c, n)])
    left = routed.withColumns({
        "part": F.explode(F.sequence(F.lit(0), F.element_at(split, F.col("cell")) - 1)),
    }).withColumn("chunk", F.floor(hash_uniform("test_id", "chunk") * F.element_at(chunks, F.col("cell"))).cast("int"))
    right = placed.filter(F.map_contains_key(chunks, F.col("cell"))).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.element_at(chunks, F.col("cell")) - 1)))

    def search(near_rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        return _found(near_rows, block, k, p)

    keys = ["cell", "part", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, f"test_id {test_type}, train_id {id_type}, label {label_type}, distance double")
    return top_k(found, ["test_id"], [F.asc("distance"), F.asc("train_id")], k)


def knn_join(test: DataFrame, train: DataFrame, k: int = 5, p: int = 2, block_rows: int = BLOCK_ROWS,
             chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(test_id, train_id, label, distance, rank): the k nearest training rows of each test row.

    ``test``: id, features; ``train``: id, features, label. Ties by id.
    """
    return search_index(build_index(train, k, p, block_rows), test, k, chunk_rows)


def vote(neighbours: DataFrame, weights: str = "distance", k: int | None = None) -> DataFrame:
    """(test_id, prediction, share): the label with most weight, the smallest on a tie.

    Distance weighting counts 1/d; neighbours at distance zero outvote all others.
    """
    rows = neighbours.filter(F.col("rank") <= k) if k else neighbours
    by = rows.groupBy("test_id", "label").agg(
        F.sum(F.when(F.col("distance") > 0, 1.0 / F.col("distance")).otherwise(0.0)).alias("w"),
        F.count_if(F.col("distance") == 0).cast("double").alias("zero"), F.count(F.lit(1)).cast("double").alias("n"))
    tally = by.groupBy("test_id").agg(F.collect_list(F.struct("label", "w", "zero", "n")).alias("t"))  # at most k labels
    exact = F.exists("t", lambda s: s["zero"] > 0)
    scores = F.transform("t", lambda s: F.struct(
        settle(F.lit(1.0) * s["n"] if weights == "uniform" else F.when(exact, s["zero"]).otherwise(s["w"])).alias("score"),
        s["label"].alias("label")))
    tally = tally.withColumn("s", scores)
    best = F.array_max(F.transform("s", lambda s: s["score"]))
    winner = F.array_min(F.transform(F.filter("s", lambda s: s["score"] == best), lambda s: s["label"]))
    total = F.aggregate("s", F.lit(0.0), lambda a, s: a + s["score"])
    return tally.select("test_id", winner.alias("prediction"), (best / total).alias("share"),
                        F.map_from_entries(F.transform("s", lambda s: F.struct(s["label"], s["score"] / total))).alias("shares"))


def classify_knn(test: DataFrame, train: DataFrame, k: int = 5, weights: str = "distance", p: int = 2) -> DataFrame:
    """Predicted label of each test row by its k nearest training rows."""
    return vote(knn_join(test, train, k, p), weights)


def classify_stored(index: MetricIndex, rows: DataFrame, id_column: str, k: int | None = None,
                    weights: str = "distance") -> DataFrame:
    """Predicted label of raw rows by a stored index: its preprocessor makes their features, then its cells are
    searched. Rows without a preprocessor must bring ``features``."""
    ready = index.preprocessor.transform(rows) if index.preprocessor is not None else rows
    return vote(search_index(index, ready.select(F.col(id_column).alias("id"), "features"), k), weights)


def _probing(x: np.ndarray, y: np.ndarray, planes: np.ndarray, offsets: np.ndarray,
             width: float) -> Callable[[int, int], np.ndarray]:
    """``allowed`` of ``_nearest``: pairs that share a bucket in some table, where a row of x also probes the bucket one
    step across the nearer edge of each projection (query-directed multi-probe)."""
    mix = np.random.default_rng(0).integers(1, 2**63, size=planes.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    tables = []
    for plane, offset in zip(planes, offsets):
        stored = (np.floor(y @ plane.T / width + offset).astype(np.int64).astype(np.uint64) * mix).sum(1)
        keys, bucket = np.unique(stored, return_inverse=True)  # 64-bit digests of the buckets
        at = x @ plane.T / width + offset
        base = np.floor(at).astype(np.int64)
        own = (base.astype(np.uint64) * mix).sum(1)
        step = np.where(at - base < 0.5, -1, 1).astype(np.int64).astype(np.uint64) * mix
        probes = np.concatenate([own[:, None], own[:, None] + step], axis=1)
        place = np.minimum(np.searchsorted(keys, probes), len(keys) - 1)
        place[keys[place] != probes] = len(keys)  # a bucket without rows
        by = np.argsort(bucket, kind="stable")
        starts = np.append(np.searchsorted(bucket[by], np.arange(len(keys) + 1)), len(y))
        tables.append((place, bucket, by, starts))

    def allowed(start: int, end: int) -> np.ndarray:
        out = np.zeros((end - start, len(y)), bool)
        for place, bucket, by, starts in tables:
            asked = place[start:end]
            sizes = starts[asked + 1] - starts[asked]
            if sizes.sum() * 8 < out.size:  # few: name every pair
                n = sizes.sum(1)
                flat = sizes.ravel()
                inside = np.arange(flat.sum()) - np.repeat(np.cumsum(flat) - flat, flat)
                out[np.repeat(np.arange(end - start), n), by[np.repeat(starts[asked].ravel(), flat) + inside]] = True
            else:
                probed = np.zeros((end - start, len(starts) - 1), bool)
                probed[np.arange(end - start)[:, None], asked] = True
                out |= np.take(probed, bucket, axis=1)
        return out

    return allowed


def approx_knn_join(test: DataFrame, train: DataFrame, k: int = 5, tables: int = 12, projections: int = 6,
                    width: float | None = None, width_factor: float = 3.0, sample_rows: int = 2_000,
                    seed: int = 7) -> DataFrame:
    """(test_id, train_id, label, distance, rank): approximate k nearest training rows by Euclidean distance.

    Every row is hashed in ``tables`` tables of ``projections`` random projections cut into buckets of ``width``;
    a test row probes its own bucket and, per projection, the bucket across the nearer edge. Rows that share a probed
    bucket are candidates; their exact distances rank them (ties by id). No candidate list is capped, so a row with
    fewer than k candidates gets fewer rows. ``width`` defaults to ``width_factor`` times the median distance to the nearest other row
    in a sample of at most ``sample_rows`` training rows (the only bounded sample; every row is hashed and searched).
    """
    test, train = (df if isinstance(df.schema["features"].dataType, T.ArrayType) else _arrays(df) for df in (test, train))
    id_type, label_type, test_type = dict(train.dtypes)["id"], dict(train.dtypes)["label"], dict(test.dtypes)["id"]
    first = train.select("features").first()
    if first is None:
        return test.limit(0).select(F.col("id").alias("test_id"), F.lit(None).cast(id_type).alias("train_id"),
                                    F.lit(None).cast(label_type).alias("label"), F.lit(0.0).alias("distance"),
                                    F.lit(0).alias("rank"))
    dim = len(first.features)
    if width is None:
        sample = np.stack(sample_n(train.select("id", "features"), sample_rows, "id").toPandas()["features"].to_numpy()).astype(float)
        d = _distances(sample, sample, 2)
        np.fill_diagonal(d, np.inf)
        nearest = d.min(1)
        width = width_factor * float(np.median(nearest[np.isfinite(nearest)])) if np.isfinite(nearest).any() else 1.0
        width = width or 1.0
    rng = np.random.default_rng(seed)
    planes, offsets = rng.normal(size=(tables, projections, dim)), rng.uniform(size=(tables, projections))
    # pairs stay inside a task: every block of training rows meets every chunk of test rows, each hashed where they meet
    parts, chunks = (max(1, math.ceil(df.count() / size)) for df, size in ((train, BLOCK_ROWS), (test, CHUNK_ROWS)))
    left = test.filter(F.col("id").isNotNull()).select(
        F.col("id").alias("test_id"), F.col("features").alias("features"), F.floor(hash_uniform("id", "chunk") * chunks).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    right = train.filter(F.col("id").isNotNull()).select(
        "id", "features", "label", F.floor(hash_uniform("id", "part") * parts).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))

    def search(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        return _found(asked, block, k, 2, lambda x, y: _probing(x, y, planes, offsets, width))

    found = left.groupBy("part", "chunk").cogroup(right.groupBy("part", "chunk")).applyInPandas(
        search, f"test_id {test_type}, train_id {id_type}, label {label_type}, distance double")
    return top_k(found, ["test_id"], [F.asc("distance"), F.asc("train_id")], k)


def recall(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: share of the exact neighbours (test_id, train_id) that the approximate search found, and counts."""
    found = exact.select("test_id", "train_id").join(approx.select("test_id", "train_id", F.lit(1).alias("hit")),
                                                     ["test_id", "train_id"], "left")
    return found.agg(F.count(F.lit(1)).alias("exact_pairs"), F.count("hit").alias("found_pairs"),
                     (F.count("hit") / F.count(F.lit(1))).alias("recall"))
