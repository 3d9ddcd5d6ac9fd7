"""Model checks: the LR objective mapping against an independent solver, and the
feature builder's encoding rules (H1)."""
import threading
import uuid

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevscope.operators import features as FE
from sevscope.operators import forest as FO
from sevscope.operators import metrics as M
from sevscope.plans import models as MO
from sevscope.plans.model_store import ModelStore, fingerprint


def _newton(X, y, w, C, iters=100):
    """argmin C * sum w_i logloss_i + 0.5 |beta|^2 (intercept not penalised)."""
    n, d = X.shape
    Z = np.hstack([X, np.ones((n, 1))])
    b = np.zeros(d + 1)
    reg = np.eye(d + 1)
    reg[-1, -1] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-Z @ b))
        g = C * Z.T @ (w * (p - y)) + reg @ b
        H = C * (Z * (w * p * (1 - p))[:, None]).T @ Z + reg
        b -= np.linalg.solve(H, g)
    return b


@pytest.mark.parametrize("C", [0.1, 1.0])
def test_weighted_lr_matches_reference_objective(spark, C):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(400, 3))
    y = (X @ np.array([1.5, -2.0, 0.5]) + rng.normal(size=400) > 0.8).astype(int)
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("severe", T.IntegerType())])
    df = spark.createDataFrame([(Vectors.dense(x.tolist()), int(t)) for x, t in zip(X, y)], schema)
    model = MO.fit_lr(df, C, tol=1e-10)
    n, pos = len(y), y.sum()
    w = np.where(y == 1, n / (2 * pos), n / (2 * (n - pos)))
    ref = _newton(X, y, w, C)
    got = np.append(model.coefficients.toArray(), model.intercept)
    assert np.allclose(got, ref, atol=1e-4)


def test_feature_builder_unseen_and_null(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", None), ("b", 3.0)], "cat string, num double")
    test = spark.createDataFrame([("zzz", 5.0), (None, None)], "cat string, num double")
    spec = FE.fit_features(train, ["cat", "num"])
    assert spec.names == ["num", "cat_a", "cat_b"]
    assert spec.medians["num"] == 2.0
    rows = [r.features.toArray().tolist() for r in spec.transform(test).collect()]
    m, s = spec.stats["num"]
    assert rows[0] == pytest.approx([(5.0 - m) / s, 0.0, 0.0])   # unseen level -> zeros
    assert rows[1] == pytest.approx([(2.0 - m) / s, 0.0, 0.0])   # NULL -> "Unknown" (unseen)


def test_too_many_levels_raise(spark, monkeypatch):
    df = spark.range(50).selectExpr("cast(id as string) as road", "cast(id % 3 as string) as hit", "1.0D as speed")
    monkeypatch.setattr(FE, "MAX_LEVELS", 53)
    assert len(FE.fit_features(df, ["road", "hit", "speed"]).names) == 54
    monkeypatch.setattr(FE, "MAX_LEVELS", 52)
    with pytest.raises(ValueError, match=r"more than 52 values in all: road \(50\), hit \(3\)"):
        FE.fit_features(df, ["road", "hit", "speed"])


def test_constant_numeric_is_zero_on_train(spark):
    train = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    out, stats = FE.standardise(train, ["x"])
    assert [r.x for r in out.collect()] == [0.0, 0.0]


def _noisy(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 5)).round(2)
    y = (X[:, 0] * X[:, 1] + rng.normal(size=n) > 0).astype(int)
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("severe", T.IntegerType())])
    return spark.createDataFrame([(Vectors.dense(x.tolist()), int(t)) for x, t in zip(X, y)], schema)


def test_prefixes_of_a_forest_are_averages_of_its_trees(spark, tmp_path):
    df = _noisy(spark).coalesce(1)
    model = MO.fit_rf(df, 7, None, 2)
    model.write().overwrite().save(str(tmp_path / "f"))
    got = FO.grid_scores(model, str(tmp_path / "f"), df, "severe", [1, 3, 7], [None, 4])
    rows = df.select("features", "severe").collect()
    per_tree = np.array([[t.predictProbability(r.features)[1] for t in model.trees] for r in rows])
    for n in (1, 3, 7):
        own = sorted(r.prob for r in got.where(f"n_est = {n} and depth is null").collect())
        assert np.allclose(own, np.sort(per_tree[:, :n].mean(axis=1)))
    assert got.count() == 6 * len(rows)


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_cut_tree_is_the_tree_of_that_depth(spark, tmp_path, depth):
    df = _noisy(spark, 300, 9).coalesce(1)
    fit = lambda d: RandomForestClassifier(labelCol="severe", numTrees=1, maxDepth=d, featureSubsetStrategy="all", bootstrap=False, seed=1).fit(df)
    deep = fit(12)
    deep.write().overwrite().save(str(tmp_path / "f"))
    got = sorted(r.prob for r in FO.grid_scores(deep, str(tmp_path / "f"), df, "severe", [1], [depth]).collect())
    want = sorted(r.prob for r in MO.with_probability(fit(depth).transform(df)).collect())
    assert np.allclose(got, want)


def test_stopped_search_goes_on(spark):
    store = ModelStore(spark, f"test-{uuid.uuid4().hex}")
    made = []

    def point(i, stop):
        def make():
            if i == stop:
                raise RuntimeError("executor lost")
            made.append(i)
            return {"i": i, "auc": 0.5, "none": None}
        return store.result(f"p{i}", make)

    with pytest.raises(RuntimeError):
        [point(i, 2) for i in range(4)]
    again = ModelStore(spark, store.root.rsplit("/", 1)[1])
    store = again
    assert [point(i, None)["i"] for i in range(4)] == [0, 1, 2, 3]
    assert made == [0, 1, 2, 3]  # none twice
    df = _noisy(spark, 60)
    fits = []
    make = lambda: fits.append(1) or MO.fit_rf(df, 2, 3, 1)
    for _ in range(2):
        model, path = store.model("rf", RandomForestClassificationModel.load, make)
    assert len(fits) == 1 and model.getNumTrees == 2


def test_fingerprint_is_of_rows_in_any_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    assert fingerprint(a, "p", None) == fingerprint(a.orderBy("k", ascending=False).repartition(3), "p", None)
    assert len({fingerprint(a, "p"), fingerprint(a, "q"), fingerprint(a.where("k = 1"), "p"), fingerprint(a.distinct(), "p")}) == 4


def test_fingerprint_of_many_rows_does_not_overflow(spark):
    many = spark.range(200_000).selectExpr("id as k")
    assert fingerprint(many, "p") == fingerprint(many.repartition(5), "p") != fingerprint(many.where("k > 0"), "p")


def test_registered_queries_search_whole_grids(spark, monkeypatch):
    """Every point of the grids is tried at both levels; cheap fits stand in for the estimators."""
    from tests.conftest import SF_SMALL
    from sevscope.plans import q_models as Q
    fits, models, lock, root = [], {}, threading.Lock(), f"test-{uuid.uuid4().hex}"

    def stand_in(family, estimator):
        def fit(train, *point, **named):
            with lock:
                fits.append((family, *point, *named.values()))
                if (family, id(train)) not in models:
                    models[family, id(train)] = train, estimator.fit(train)
                return models[family, id(train)][1]
        return fit

    init = ModelStore.__init__
    monkeypatch.setattr(ModelStore, "__init__", lambda self, spark, name: init(self, spark, f"{root}/{name}"))
    monkeypatch.setattr(MO, "_sweep_best", lambda model, val: {"threshold": 0.5, "f1": 0.5, "recall": 0.5, "meets_floor": 1})
    monkeypatch.setattr(MO, "fit_rf", stand_in("RF", RandomForestClassifier(labelCol=MO.LABEL, numTrees=300, maxDepth=1, seed=1)))
    monkeypatch.setattr(MO, "fit_gbt", stand_in("XGB", GBTClassifier(labelCol=MO.LABEL, maxIter=1, maxDepth=1, seed=1)))
    chosen = Q.best_per_level(spark, SF_SMALL).orderBy("automation_level").collect()
    assert [r.algorithm for r in chosen] == ["RF", "LR"]
    assert not [f for f in fits if f[0] == "XGB"] and len([f for f in fits if f[0] == "RF"]) == 4  # a leaf size each, and the refit
    search = lambda: MO.stratified_models(Q._known(spark, SF_SMALL), {"ADS": ("RF", "XGB")})
    results, tables = search()
    assert [(r["automation_level"], r["algorithm"]) for r in results] == [("ADS", "RF"), ("ADS", "XGB")]
    xgb = [f for f in fits if f[0] == "XGB"]
    assert len(xgb) == 28 and len({f[1:3] for f in xgb}) == 9 and set(tables) == {"rf_ads", "xgb_ads"}
    assert len([f for f in fits if f[0] == "RF"]) == 4  # read back
    before = len(fits)
    assert search() == (results, tables) and len(fits) == before


def test_forest_grid_has_all_points(spark):
    df = _noisy(spark, 200)
    mats = lambda: MO.Matrices(df, df, df, df, list("abcde"), "temporal")
    grid = {"n_est": [2, 4, 6], "depth": [None, 2, 3], "leaf": [1, 5]}
    res = MO.run_rf_grid("ADS", mats, ModelStore(spark, f"test-{uuid.uuid4().hex}"), grid)
    assert [tuple(p["params"].values()) for p in res.points] == [(n, d, leaf) for n in (2, 4, 6) for d in (None, 2, 3) for leaf in (1, 5)]
    assert all(0 <= p["best"]["f1"] <= 1 for p in res.points) and res.params in [p["params"] for p in res.points]
    assert len(res.table) == 5 and res.metrics["model"] == "RF [ADS]"


def test_large_forest_is_fitted_and_scored_in_parts(spark, tmp_path, monkeypatch):
    assert FO.part_sizes(4_000, 300) == [300] and FO.part_sizes(306_349, 300) == [19] * 15 + [15] and FO.part_sizes(10**8, 2) == [1, 1]
    df = _noisy(spark, 200)
    df.coalesce(1).write.parquet(str(tmp_path / "m"))
    df = spark.read.parquet(str(tmp_path / "m"))
    monkeypatch.setattr(FO, "ROW_TREES", 400)
    mats = lambda: MO.Matrices(df, df, df, df, list("abcde"), "temporal")
    fits, fit_rf = [], MO.fit_rf
    monkeypatch.setattr(MO, "fit_rf", lambda train, n, *p, **k: fits.append(n) or fit_rf(train, n, *p, **k))
    store = ModelStore(spark, f"test-{uuid.uuid4().hex}")
    res = MO.run_rf_grid("ADS", mats, store, {"n_est": [3, 5], "depth": [None, 2], "leaf": [1]})
    assert len(res.points) == 4 and max(fits) == 2 and fits[:3] == [2, 2, 1] and sum(fits) == 5 + res.params["n_est"]
    assert sum(r["importance"] for r in res.table) == pytest.approx(1.0) and len(res.table) == 5
    paths = [f"{store.root}/fits/rf-ADS-leaf1-part{i}" for i in range(3)]
    parts = [(RandomForestClassificationModel.load(p), p) for p in paths]
    rows = df.collect()
    trees = [t for model, _ in parts for t in model.trees]
    per_tree = np.array([[t.predictProbability(r.features)[1] for t in trees] for r in rows])
    assert len({t.toDebugString.split("\n", 1)[1] for t in trees}) == 5  # drawn anew in each part
    got = FO.part_scores(parts, df, "severe", [3, 5], [None, 2])
    assert got.count() == 4 * len(rows)
    for n in (3, 5):
        own = sorted(r.prob for r in got.where(f"n_est = {n} and depth is null").collect())
        assert np.allclose(own, np.sort(per_tree[:, :n].mean(axis=1)))


def test_sweep_of_a_histogram_is_the_sweep_of_the_rows(spark):
    rng = np.random.default_rng(2)
    rows = [("a" if i % 3 else None, float(p), int(t)) for i, (p, t) in enumerate(zip(rng.random(500).round(2), rng.random(500) < 0.4))]
    df = spark.createDataFrame(rows + [("a", None, 1), ("a", 0.5, None)], "m string, prob double, severe int")
    hist = M.score_histogram(df, "severe", "prob", ["m"])
    key = lambda d: sorted(map(str, d.collect()))
    assert key(M.sweep_histogram(hist, "prob", by=["m"])) == key(M.threshold_sweep(df, "severe", "prob", by=["m"]))


def test_boosted_trees_without_cached_node_ids_are_the_same(spark):
    rng = np.random.default_rng(3)
    X = rng.integers(0, 6, size=(600, 5))
    y = (X[:, 0] * X[:, 1] + rng.integers(0, 8, size=600) > 12).astype(int)
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("severe", T.IntegerType())])
    rows = spark.createDataFrame([(Vectors.dense(x.tolist()), int(v)) for x, v in zip(X, y)], schema)
    model = MO.fit_gbt(rows, 0.1, 4, 1.5, rounds=4)
    cached = GBTClassifier(labelCol=MO.LABEL, weightCol=MO.WEIGHT, maxIter=4, stepSize=0.1, maxDepth=4, seed=42, cacheNodeIds=True).fit(
        FE.pos_weight_col(rows, MO.LABEL, 1.5, MO.WEIGHT))
    assert not model.getCacheNodeIds() and cached.getCacheNodeIds()
    assert model.toDebugString.split("\n")[1:] == cached.toDebugString.split("\n")[1:]
    assert model.treeWeights == cached.treeWeights


def test_fits_read_every_row_of_the_sub_train(spark, monkeypatch):
    n = 2_000_010
    rows = spark.range(n).selectExpr("cast(id as string) as incident_key")
    monkeypatch.setattr(MO.SP, "split_within_level", lambda lvl: MO.SP.Split(rows, rows.limit(10), "temporal"))
    monkeypatch.setattr(MO.SP, "holdout", lambda train: (train, train.limit(10)))
    monkeypatch.setattr(MO.FE, "fit_features", lambda df, feats: FE.FeatureSpec([], [], {}, {}, None))
    monkeypatch.setattr(MO, "_design", lambda spec, df: df)
    m = MO._matrices(rows, [], refit_on_full=True)
    assert m.fit.count() == m.train.count() == n
