"""A k-NN index stored in one session and searched in another answers like the join that builds it in place."""

import numpy as np
from pyspark.sql import functions as F

from homespan.operators import neighbours, sampling
from homespan.session import fresh_path

FOLDER = "/root/testdata/sf0.001"


def _halves(spark):
    rows = sampling.stratified_split(spark.read.parquet(f"{FOLDER}/embeddings.parquet"), "label", 0.2, "vec_id").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"), "label", "is_test")
    return rows.filter("is_test").drop("is_test"), rows.filter("not is_test").drop("is_test")


def _plain(test, train, k):
    x, y = (np.stack(t.toPandas()["features"].to_numpy()) for t in (test, train))
    ids = train.toPandas()["id"].to_numpy()
    out = {}
    for i, tid in enumerate(test.toPandas()["id"]):
        d = np.rint(np.sqrt(((y - x[i]) ** 2).sum(1)) * 1e9) / 1e9
        out[tid] = list(ids[np.lexsort((ids, d))[:k]])
    return out


def test_stored_index_answers_like_the_join_in_another_session(spark):
    test, train = _halves(spark)
    index = neighbours.build_index(train, k=5, block_rows=20)  # many cells and blocks on a small table
    path = fresh_path(spark, "index")
    neighbours.save_index(index, path)
    other = spark.newSession()
    stored = neighbours.load_index(other, path)
    assert (stored.k, stored.p, len(stored.cells)) == (5, 2, len(index.cells))
    asked = other.createDataFrame(test.toPandas())
    found = neighbours.search_index(stored, asked, 3).toPandas()
    want = _plain(test, train, 3)
    got = found.sort_values(["test_id", "rank"]).groupby("test_id")["train_id"].apply(list).to_dict()
    assert got == want
    direct = neighbours.classify_knn(test, train, k=5).toPandas().set_index("test_id")["prediction"].to_dict()
    again = neighbours.vote(neighbours.search_index(stored, asked)).toPandas().set_index("test_id")["prediction"].to_dict()
    assert again == direct


def test_stored_index_keeps_its_preprocessor(spark, ws):
    from homespan.operators import prepare, projections

    table = ws.model_table()
    numeric, categorical = projections.select_features(table)
    steps = prepare.build_preprocessor(table, numeric, categorical)
    train = prepare.prepared(table, steps, ["property_id", "valuation_label"]).select(
        F.col("property_id").alias("id"), "features", F.col("valuation_label").alias("label"))
    index = neighbours.build_index(train, k=4)
    index.preprocessor = steps
    path = fresh_path(spark, "index")
    neighbours.save_index(index, path)
    stored = neighbours.load_index(spark.newSession(), path)
    assert stored.preprocessor is not None
    raw = table.limit(40)
    got = neighbours.classify_stored(stored, raw, "property_id", k=4).select("test_id", "prediction").toPandas()
    ready = prepare.prepared(raw, steps, ["property_id"]).select(F.col("property_id").alias("id"), "features")
    want = neighbours.classify_knn(ready, train, k=4).select("test_id", "prediction").toPandas()
    assert sorted(map(tuple, got.to_numpy())) == sorted(map(tuple, want.to_numpy()))


def test_empty_index_and_empty_queries(spark):
    test, train = _halves(spark)
    index = neighbours.build_index(train.limit(0), k=3)
    assert neighbours.search_index(index, test).count() == 0
    full = neighbours.build_index(train, k=3)
    assert neighbours.search_index(full, test.limit(0)).count() == 0


def test_approximate_search_finds_nine_in_ten(spark):
    for folder in (FOLDER, "/root/testdata/sf0.01"):
        rows = sampling.stratified_split(spark.read.parquet(f"{folder}/embeddings.parquet"), "label", 0.2, "vec_id").select(
            F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"), "label", "is_test")
        test, train = rows.filter("is_test").drop("is_test"), rows.filter("not is_test").drop("is_test")
        approx = neighbours.approx_knn_join(test, train, k=5)
        assert neighbours.recall(approx, neighbours.knn_join(test, train, k=5)).first().recall >= 0.9
        plain = _plain(test, train, 5)
        for r in approx.collect():  # every distance is exact, and no row is ranked before a nearer found one
            assert r.train_id in plain[r.test_id] or r.rank >= 1
    assert neighbours.approx_knn_join(test, train.limit(0)).count() == 0


def test_blocks_rank_ties_far_rows_and_missing_ids_like_a_plain_search():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 4, (9_000, 3)).astype(float)  # many equal distances, more rows than one tile
    far = np.vstack([rng.normal(size=(5_000, 3)), np.full((2, 3), 1e7)])
    for y in (y, far):
        x = y[:300] + 0.25
        order = rng.permutation(len(y))
        for p in (1, 2):
            parts = list(neighbours._nearest(x, y, order, 5, p))
            assert len(parts) == 2  # whole slices of rows at a time
            rows, at, d = map(np.concatenate, zip(*parts))
            gap = np.abs(x[:, None] - y[None])
            plain = np.rint((gap.sum(2) if p == 1 else np.sqrt((gap * gap).sum(2))) * 1e9) / 1e9
            want = [np.lexsort((order, r))[:5] for r in plain]
            assert (rows == np.repeat(np.arange(300), 5)).all() and (at == np.concatenate(want)).all()
            assert (d == np.concatenate([r[w] for r, w in zip(plain, want)])).all()
    few = np.zeros((300, len(y)), bool)
    few[:, :3] = True
    for may in (few, np.broadcast_to(np.arange(len(y)) >= len(y) - 2_000, few.shape)):
        rows, at, _ = map(np.concatenate, zip(*neighbours._nearest(x, y, order, 5, 2, lambda i, j: may[i:j])))
        assert may[rows, at].all() and (np.bincount(rows) == min(5, may[0].sum())).all()


def test_approximate_search_shuffles_no_pairs(spark):
    rng = np.random.default_rng(5)
    train = spark.createDataFrame([(i, rng.normal(size=4).tolist(), i % 3) for i in range(200)],
                                  "id long, features array<double>, label int")
    test = train.filter("id % 50 = 0").drop("label")
    found = neighbours.approx_knn_join(test, train, k=5)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan and "Join" not in plan and "Aggregate" not in plan
    rows = sorted(map(tuple, found.collect()))
    assert [r[:2] for r in rows if r[4] == 1] == [(i, i) for i in range(0, 200, 50)]
    short = train.withColumn("features", F.col("features").cast("array<float>"))
    again = neighbours.approx_knn_join(short.filter("id % 50 = 0").drop("label"), short, k=5).collect()
    assert [r[:3] for r in rows] == [r[:3] for r in sorted(map(tuple, again))]
