"""Severity models as distributed ``pyspark.ml`` jobs.

Each fit is a distributed estimator run; the driver only loops over the small
hyper-parameter grid and reads back metric rows. Frames reused across a grid are
checkpointed once (``cut_lineage``), so a lost executor re-reads the checkpoint
instead of recomputing cleaning + flags + features. Finished grid points and forests are
kept (``model_store``), so a search that was stopped goes on where it stood and queries over the same
search share it. One forest per leaf size answers all its numbers of trees and depths (``operators.forest``).

Mapping of the reference's estimators:
  * weighted L2 logistic regression: ``regParam = 1 / (C * sum(w))``,
    ``standardization=False`` - the same objective up to a constant factor;
  * random forest: ``RandomForestClassifier`` with balanced weights, depth None -> 30;
  * boosted trees: ``GBTClassifier`` with positive-class weight ``spw`` (a different
    loss scaling than the reference's library, so metrics are comparable in kind).
"""
from __future__ import annotations

import functools
import math
import threading
from dataclasses import dataclass, field
from itertools import product

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import narrative as N
from ..functions.flags import threshold_decision
from ..operators import features as FE
from ..operators import forest as FO
from ..operators import metrics as M
from ..operators import splits as SP
from ..session import cut_lineage
from .model_store import ModelStore, fingerprint

LABEL = "severe"
WEIGHT = "weight"

# FIXED VALUES: the reference's grids and fixed refit settings
LR_C_GRID = [0.1, 0.3, 1.0, 3.0, 10.0]
RF_GRID = {"n_est": [100, 200, 300], "depth": [None, 5, 10], "leaf": [1, 5, 10]}
GBT_GRID = {"lr": [0.05, 0.1, 0.2], "depth": [3, 5, 7], "spw": [0, 1, 2]}  # spw option index
GBT_ROUNDS = 200
FIXED_ADS_BOOSTED = {"lr": 0.05, "depth": 5, "spw": 1, "threshold": 0.46}
FIXED_L2_LR = {"C": 0.1, "threshold": 0.20}
BEST_PER_LEVEL = {"ADS": "RF", "L2": "LR"}
MAX_DEPTH_NONE = 30  # Spark's deepest tree stands in for "unlimited"


def context_features(df: DataFrame, base=S.CONTEXT_FEATURES) -> list[str]:
    """Listed features that exist in the frame."""
    return [c for c in base if c in df.columns]


def with_probability(pred: DataFrame, out: str = "prob") -> DataFrame:
    return pred.withColumn(out, vector_to_array("probability").getItem(1))


# --- estimators -----------------------------------------------------------------------

def fit_lr(train: DataFrame, C: float = 1.0, features: str = "features", max_iter: int = 2000,
           tol: float = 1e-6):
    """Class-balanced L2 logistic regression.

    Balanced weights sum to n when both classes are present, so
    ``regParam = 1 / (C * n)`` needs only the class counts (one aggregate).
    """
    w, n = FE.balanced_weight_col(train, LABEL, WEIGHT, return_total=True)
    lr = LogisticRegression(featuresCol=features, labelCol=LABEL, weightCol=WEIGHT,
                            regParam=1.0 / (C * max(n, 1.0)), elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, tol=tol)
    return lr.fit(w)


def fit_rf(train: DataFrame, n_est: int, depth, leaf: int, features: str = "features", seed: int = 42):
    """Class-balanced random forest (I4)."""
    w = FE.balanced_weight_col(train, LABEL, WEIGHT)
    rf = RandomForestClassifier(featuresCol=features, labelCol=LABEL, weightCol=WEIGHT,
                                numTrees=n_est, maxDepth=MAX_DEPTH_NONE if depth is None else depth,
                                minInstancesPerNode=leaf, featureSubsetStrategy="sqrt", seed=seed,
                                cacheNodeIds=True, maxMemoryInMB=1024)
    return rf.fit(w)


def fit_gbt(train: DataFrame, lr: float, depth: int, spw: float, rounds: int = GBT_ROUNDS,
            features: str = "features", seed: int = 42):
    """Boosted trees with a positive-class weight.

    No node ids are cached: walking a few levels costs less than rewriting a table of them at every level of every round.
    """
    w = FE.pos_weight_col(train, LABEL, spw, WEIGHT)
    gbt = GBTClassifier(featuresCol=features, labelCol=LABEL, weightCol=WEIGHT, maxIter=rounds,
                        stepSize=lr, maxDepth=depth, seed=seed, cacheNodeIds=False)
    return gbt.fit(w)


def spw_options(train: DataFrame) -> list[float]:
    rows = FE.pos_weight_grid(train, LABEL).orderBy("option").collect()
    return [r["spw"] for r in rows]


# --- evaluation -----------------------------------------------------------------------

def evaluate_at(scored: DataFrame, threshold: float, by: list[str] | None = None) -> dict | list:
    """Metrics of ``prob >= threshold`` (F16, F17, E3); one row per group."""
    pred = scored.withColumn("pred", threshold_decision("prob", threshold))
    rows = M.evaluate(pred, LABEL, "pred", "prob", by, digits=None).collect()
    return [r.asDict() for r in rows]


@dataclass
class ModelResult:
    metrics: dict
    table: list = field(default_factory=list)   # coefficients or importances
    params: dict = field(default_factory=dict)
    points: list = field(default_factory=list)  # grid points with their best thresholds


def _coef_rows(model, names: list[str]) -> list[dict]:
    coefs = model.coefficients.toArray().tolist()
    rows = [{"feature": n, "coefficient": c, "odds_ratio": math.exp(c)} for n, c in zip(names, coefs)]
    return sorted(rows, key=lambda r: -abs(r["coefficient"]))


def _imp_rows(model, names: list[str]) -> list[dict]:
    imps = model.featureImportances.toArray().tolist()
    return sorted([{"feature": n, "importance": v} for n, v in zip(names, imps)],
                  key=lambda r: -r["importance"])


#: Rows of a design matrix that one task of a fit reads; a fit runs many short jobs, so small matrices take few tasks.
FIT_ROWS_PER_TASK = 20_000


def _design(spec: FE.FeatureSpec, df: DataFrame) -> DataFrame:
    """What a fit or a score reads of ``df``, written once: design vector and label."""
    return cut_lineage(spec.transform(df).select("features", LABEL))


def _compact(matrix: DataFrame) -> DataFrame:
    return matrix.coalesce(max(1, math.ceil(matrix.count() / FIT_ROWS_PER_TASK)))


@dataclass
class Matrices:
    """Design matrices of one level; ``train`` is what the final model is fitted on."""
    fit: DataFrame
    val: DataFrame
    train: DataFrame
    test: DataFrame
    names: list[str]
    split_type: str


def _matrices(lvl: DataFrame, feats: list[str], refit_on_full: bool = False) -> Matrices:
    """By default - as the reference does - the final model and its test matrix also use
    the sub-train; ``refit_on_full`` fits both on the whole train."""
    sp = SP.split_within_level(lvl)
    fit_df, val_df = SP.holdout(sp.train)
    spec = FE.fit_features(fit_df, feats)
    fit_m = _compact(_design(spec, fit_df))
    val_m = _design(spec, val_df)
    train_m = fit_m
    if refit_on_full:
        spec = FE.fit_features(sp.train, feats)
        train_m = _compact(_design(spec, sp.train))
    return Matrices(fit_m, val_m, train_m, _design(spec, sp.test), spec.names, sp.split_type)


GRID_PARALLELISM = 4
ALL_SLICE = "__all__"


def _grid_map(fn, points, parallelism: int = GRID_PARALLELISM) -> list:
    """Evaluate grid points as concurrent Spark jobs from a small thread pool (as
    ``CrossValidator(parallelism=...)`` does). Results keep grid order, so ties
    resolve exactly as in a sequential loop."""
    from concurrent.futures import ThreadPoolExecutor
    points = list(points)
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(points)))) as pool:
        return list(pool.map(fn, points))


def _sweep_best(model, val_m) -> dict:
    val = with_probability(model.transform(val_m))
    return M.best_threshold(M.threshold_sweep(val, LABEL, "prob", digits=None))


def _select(candidates: list[dict]) -> dict:
    """Best by (meets floor, F1, recall); first wins ties (strict >)."""
    best = None
    for c in candidates:
        b = c["best"]
        key = (b.get("meets_floor", 0), b.get("f1", 0.0), b.get("recall", 0.0))
        if best is None or key > best[0]:
            best = (key, c)
    return best[1]


def _final(level: str, name: str, chosen: dict, fit, table, mats) -> dict:
    """Refit of the chosen point and its test metrics at the chosen threshold."""
    m = mats()
    model = fit(m.train)
    metrics = evaluate_at(with_probability(model.transform(m.test)), chosen["best"]["threshold"])[0]
    metrics.update(model=f"{name} [{level}]", threshold=chosen["best"]["threshold"], automation_level=level, split_type=m.split_type)
    return {"metrics": metrics, "table": table(model, m.names), "params": chosen["params"]}


def run_lr_grid(level: str, mats, store: ModelStore, grid=LR_C_GRID) -> ModelResult:
    """C grid x threshold sweep on validation, refit, test metrics."""
    def point(c):
        return store.result(f"lr-{level}-{c}", lambda: {"params": {"C": c}, "best": _sweep_best(fit_lr(mats().fit, c), mats().val)})
    chosen = _select(_grid_map(point, grid))
    res = store.result(f"lr-{level}-final", lambda: _final(level, "LR", chosen, lambda t: fit_lr(t, **chosen["params"]), _coef_rows, mats))
    res["metrics"].update(chosen["params"])
    return ModelResult(**res)


def _rf_parts(store: ModelStore, name: str, train: DataFrame, sizes: list[int], depth, leaf: int):
    """(model, path) of the parts of a forest, one after the other; each is kept. Seeds lie further apart than a fit's
    partitions, which Spark numbers from its seed."""
    for i, n in enumerate(sizes):
        yield store.model(f"{name}-part{i}", RandomForestClassificationModel.load,
                          functools.partial(fit_rf, train, n, depth, leaf, seed=42 + 1_000_003 * i))


def _final_parts(level: str, chosen: dict, parts, m: Matrices) -> dict:
    """``_final`` of a forest in parts: scores and importances are means over all its trees."""
    total = [0.0] * len(m.names)

    def counted():
        for model, path in parts:
            for j, v in enumerate(model.featureImportances.toArray().tolist()):
                total[j] += v * model.getNumTrees
            yield model, path

    params, threshold = chosen["params"], chosen["best"]["threshold"]
    metrics = evaluate_at(FO.part_scores(counted(), m.test, LABEL, [params["n_est"]], [None]), threshold)[0]
    metrics.update(model=f"RF [{level}]", threshold=threshold, automation_level=level, split_type=m.split_type)
    all_of = sum(total) or 1.0
    table = sorted([{"feature": n, "importance": v / all_of} for n, v in zip(m.names, total)], key=lambda r: -r["importance"])
    return {"metrics": metrics, "table": table, "params": params}


def run_rf_grid(level: str, mats, store: ModelStore, grid=None) -> ModelResult:
    """Forest grid x threshold sweep (I4): one forest per leaf size, whose trees' prefixes and cuts give
    the scores of its other points; one histogram of all scores answers every threshold of every point."""
    grid = grid or RF_GRID
    most = None if None in grid["depth"] else max(grid["depth"])

    def leaf_points(leaf):
        name = f"rf-{level}-leaf{leaf}"

        def make():
            fit_m, n_est = mats().fit, max(grid["n_est"])
            sizes = FO.part_sizes(fit_m.count(), n_est)
            if len(sizes) == 1:
                model, path = store.model(name, RandomForestClassificationModel.load, lambda: fit_rf(fit_m, n_est, most, leaf))
                scores = FO.grid_scores(model, path, mats().val, LABEL, grid["n_est"], grid["depth"])
            else:
                scores = FO.part_scores(_rf_parts(store, name, fit_m, sizes, most, leaf), mats().val, LABEL, grid["n_est"], grid["depth"])
            by = ["n_est", "depth"]
            sweep = M.sweep_histogram(M.score_histogram(scores, LABEL, "prob", by), "prob", by=by, digits=None)
            return {"points": [{"params": {"n_est": r.n_est, "depth": r.depth, "leaf": leaf}, "best": r.asDict()}
                               for r in sweep.where("chosen = 1").collect()]}
        return store.result(name, make)["points"]

    found = {tuple(p["params"].values()): p for points in _grid_map(leaf_points, grid["leaf"]) for p in points}
    points = [found[p] for p in product(grid["n_est"], grid["depth"], grid["leaf"])]
    chosen = _select(points)

    def final():
        params = chosen["params"]
        sizes = FO.part_sizes(mats().train.count(), params["n_est"])
        if len(sizes) == 1:
            return _final(level, "RF", chosen, lambda t: fit_rf(t, **params), _imp_rows, mats)
        return _final_parts(level, chosen, _rf_parts(store, f"rf-{level}-final", mats().train, sizes, params["depth"], params["leaf"]), mats())

    return ModelResult(**store.result(f"rf-{level}-final", final), points=points)


def run_gbt_grid(level: str, mats, store: ModelStore, grid=None, rounds=GBT_ROUNDS) -> ModelResult:
    """Boosted grid x threshold sweep (I5); spw options from the sub-train counts (H7)."""
    grid = grid or GBT_GRID
    spws = store.result(f"xgb-{level}-spw", lambda: {"spw": spw_options(mats().fit)})["spw"]

    def point(p):
        lr, depth, opt = p
        return store.result(f"xgb-{level}-{lr}-{depth}-{opt}", lambda: {
            "params": {"lr": lr, "depth": depth, "spw": spws[opt]}, "best": _sweep_best(fit_gbt(mats().fit, lr, depth, spws[opt], rounds), mats().val)})

    points = _grid_map(point, product(grid["lr"], grid["depth"], grid["spw"]))
    chosen = _select(points)
    res = store.result(f"xgb-{level}-final", lambda: _final(
        level, "XGB", chosen, lambda t: fit_gbt(t, chosen["params"]["lr"], chosen["params"]["depth"], chosen["params"]["spw"], rounds), _imp_rows, mats))
    return ModelResult(**res, points=points)


# --- jobs ------------------------------------------------------------------------------

def pooled_baseline(known: DataFrame):
    """Pooled LR (C=1, t=0.5) on the context features incl. level: overall + per-level
    metrics, coefficient table and the missed severe rows (I2, I7, F18, B8)."""
    split = SP.split_train_test(known)
    feats = context_features(known)
    spec = FE.fit_features(split.train, feats)
    # the train matrix feeds an iterative fit: cut its lineage; the test matrix is
    # only scored (one metrics plan, one miss extraction) - a cheap projection of the
    # stage table, recomputed rather than written
    train_m = _design(spec, split.train)
    test_m = spec.transform(split.test)
    model = fit_lr(train_m, 1.0)
    scored = with_probability(model.transform(test_m)).withColumn(
        "pred", (F.col("prob") >= 0.5).cast("int"))
    # overall and per-level metrics in one plan: each row counts once for the "all"
    # slice and once for its level (a two-element explode feeding map-side partial
    # aggregates); a level slice is kept only when both classes occur in it
    every = F.col("__slice") == F.lit(ALL_SLICE)
    sl = scored.select(LABEL, "pred", "prob", F.explode(
        F.array(F.lit(ALL_SLICE), F.col("automation_level"))).alias("__slice"))
    ev = M.evaluate(sl, LABEL, "pred", "prob", ["__slice"], digits=None, presence=True)
    metrics = (ev.where(every | M.both_classes())
                 .withColumn("model", F.when(every, F.lit("Logistic Regression")).otherwise(
                     F.concat(F.lit("LR — test ["), F.col("__slice"), F.lit("]"))))
                 .drop("__slice", "__pos", "__neg"))
    fn = M.false_negatives(scored, LABEL, "pred")
    return metrics, _coef_rows(model, spec.names), fn


def stratified_models(known: DataFrame, algorithms=("LR", "RF", "XGB"), lr_grid=LR_C_GRID,
                      rf_grid=None, gbt_grid=None, gbt_rounds=GBT_ROUNDS,
                      refit_on_full: bool = False) -> tuple[list[dict], dict]:
    """Per level: own feature set, split, 25% validation, grids, test metrics.

    ADS uses tabular + 21 narrative flags; L2 tabular only. ``algorithms`` may also name them by level.
    Searches run side by side and are kept under a fingerprint of the level's rows and of the parameters.
    """
    flagged = N.ensure_narrative_flags(known)
    tab = [f for f in context_features(flagged) if f != "automation_level"]
    searches = []
    for level, feats in (("ADS", tab + N.NAV_FEATURES), ("L2", tab)):
        names = algorithms.get(level, ()) if isinstance(algorithms, dict) else algorithms
        lvl = flagged.where(F.col("automation_level") == level)
        if not names or lvl.limit(1).count() == 0:
            continue
        rows = lvl.select(*dict.fromkeys([*feats, LABEL, "incident_key", "era"]))
        store = ModelStore(known.sparkSession, fingerprint(rows, level, feats, lr_grid, rf_grid or RF_GRID, gbt_grid or GBT_GRID, gbt_rounds,
                                                           refit_on_full))
        searches += [(level, algo, _once(functools.partial(_matrices, lvl, feats, refit_on_full)) if algo == names[0] else None, store)
                     for algo in names]
    mats = {level: m for level, _, m, _ in searches if m}

    def run(search):
        level, algo, _, store = search
        if algo == "LR":
            res = run_lr_grid(level, mats[level], store, lr_grid)
        elif algo == "RF":
            res = run_rf_grid(level, mats[level], store, rf_grid)
        else:
            res = run_gbt_grid(level, mats[level], store, gbt_grid, gbt_rounds)
        res.metrics.update(algorithm=algo, feature_set="narrative+tabular" if level == "ADS" else "tabular")
        return res

    found = _grid_map(run, searches, len(searches))
    return ([r.metrics for r in found],
            {f"{algo.lower()}_{level.lower()}": r.table for (level, algo, _, _), r in zip(searches, found)})


def _once(make):
    """``make()`` when first asked, for all threads that ask."""
    lock, kept = threading.Lock(), []

    def get():
        with lock:
            if not kept:
                kept.append(make())
            return kept[0]
    return get


def best_per_level(results: list[dict], choice=BEST_PER_LEVEL) -> list[dict]:
    """Configurable model selection; defaults to the reference's RF for ADS, LR for L2."""
    return [r for r in results if choice.get(r["automation_level"]) == r["algorithm"]]


def ablation(known: DataFrame) -> list[dict]:
    """LR (C=1, t=0.5) with tabular / +narrative / narrative-only features.

    ADS slice: three sets; pooled: tabular and tabular + narrative (no level feature).
    """
    flagged = N.ensure_narrative_flags(known)
    tab = [f for f in S.TABULAR_FEATURES if f in flagged.columns]
    train_all = flagged.where(F.col("era") == "archived")
    test_all = flagged.where(F.col("era") == "current")
    runs = [("ADS — tabular only", "ADS", tab), ("ADS — tabular + narrative", "ADS", tab + N.NAV_FEATURES),
            ("ADS — narrative flags only", "ADS", list(N.NAV_FEATURES)),
            ("Pooled — tabular (no automation_level)", None, tab),
            ("Pooled — tabular + narrative (no automation_level)", None, tab + N.NAV_FEATURES)]
    out = []
    for name, level, feats in runs:
        tr, te = train_all, test_all
        if level:
            tr, te = tr.where(F.col("automation_level") == level), te.where(F.col("automation_level") == level)
        spec = FE.fit_features(tr, feats)
        trm, tem = _design(spec, tr), spec.transform(te)
        model = fit_lr(trm, 1.0)
        m = evaluate_at(with_probability(model.transform(tem)), 0.5)[0]
        m["model"] = name
        if name == "ADS — tabular + narrative":
            m["nav_coefficients"] = [r for r in _coef_rows(model, spec.names)
                                     if r["feature"].startswith("nav_")]
        out.append(m)
    return out


def fixed_refit_misses(known: DataFrame, gbt_rounds: int = GBT_ROUNDS):
    """Fixed-parameter refits on all archived rows and their missed severe cases.

    ADS: boosted (lr .05, depth 5, spw = sub-train neg/pos/2, t = .46);
    L2: LR (C = .1, t = .20). Returns (summary rows, {model: FN frame}).
    """
    flagged = N.ensure_narrative_flags(known)
    tab = [f for f in context_features(flagged) if f != "automation_level"]
    summaries, misses = [], {}
    for level, feats in (("ADS", tab + N.NAV_FEATURES), ("L2", tab)):
        lvl = flagged.where(F.col("automation_level") == level)
        train = lvl.where(F.col("era") == "archived")
        test = lvl.where(F.col("era") == "current")
        sub, _ = SP.holdout(train)
        spec = FE.fit_features(train, feats)
        trm, tem = _design(spec, train), cut_lineage(spec.transform(test))
        if level == "ADS":
            cfg = FIXED_ADS_BOOSTED
            spw = spw_options(sub)[cfg["spw"]]
            model = fit_gbt(trm, cfg["lr"], cfg["depth"], spw, gbt_rounds)
            name, t = "XGB [ADS]", cfg["threshold"]
        else:
            model = fit_lr(trm, FIXED_L2_LR["C"])
            name, t = "LR [L2]", FIXED_L2_LR["threshold"]
        scored = with_probability(model.transform(tem)).withColumn(
            "pred", (F.col("prob") >= F.lit(t)).cast("int")).withColumn("model", F.lit(name))
        fn = M.false_negatives(scored, LABEL, "pred").drop("features", "rawPrediction",
                                                           "probability", "prediction")
        misses[name] = fn.withColumnRenamed("prob", "y_prob")
        summaries.append(M.miss_summary(scored, LABEL, "pred", ["model"],
                                        {"roadway_type": "top_roadway",
                                         "crash_with": "top_crash_with"}))
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    return out, misses


def pooled_vs_stratified(pooled_metrics: DataFrame, stratified: list[dict], spark: SparkSession,
                         level: str = "ADS") -> DataFrame:
    """Pooled model's level slice beside the chosen stratified model."""
    best = [r for r in best_per_level(stratified) if r["automation_level"] == level]
    cols = ["precision", "recall", "f1"]
    p = pooled_metrics.where(F.col("model") == f"LR — test [{level}]").select(
        F.lit(level).alias("automation_level"), *[F.col(c).alias(f"pooled_{c}") for c in cols])
    s = spark.createDataFrame([{"automation_level": level, **{f"stratified_{c}": float(r[c]) for c in cols}}
                               for r in best] or [], f"automation_level string, "
                              + ", ".join(f"stratified_{c} double" for c in cols))
    return p.join(s, "automation_level")
