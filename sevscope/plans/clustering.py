"""Scenario clustering jobs (I15-I19) on ``pyspark.ml``.

Matrix: tabular + narrative flags, one-hot, every slot standardised (H3).
k search: k-means per (k, restart), all in the same passes; Euclidean silhouette on the
reference's bounded 2,000-row sample; the final fit feeds the profile, lift,
label and cross-tab operators, which aggregate over the whole slice.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import narrative as N
from ..operators import clusters as K
from ..operators import features as FE
from ..operators import kmeans as KM
from ..session import cut_lineage

# FIXED VALUES: k ranges, restarts, seed and minimum slice size
K_RANGE = list(range(3, 9))
EXPLORE_K_RANGE = list(range(2, 9))
N_INIT_SEARCH = 10
N_INIT_FINAL = 20
SEED = 42
MIN_ROWS = 30
# k-means runs whose starting centres are chosen at the same time
FIT_PARALLELISM = 4


def cluster_matrix(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """One-hot + standardise every column (H3)."""
    spec = FE.fit_features(df, features, scale_numeric=False, output="__raw")
    raw = spec.transform(df)
    return FE.standardise_vector(raw, "__raw", out).drop("__raw")


def fit_kmeans(df: DataFrame, k: int, n_init: int, seed: int = SEED, features: str = "features",
               parallelism: int = FIT_PARALLELISM):
    """Best of ``n_init`` k-means runs by training cost.

    The restarts share their passes over the rows (``operators.kmeans``); the input is persisted
    once for all of them. The winner is the lowest (cost, restart index).
    """
    return best_runs(df, [k], n_init, seed, features, parallelism)[k]


def best_runs(df: DataFrame, k_range, n_init: int, seed: int = SEED, features: str = "features",
              parallelism: int = FIT_PARALLELISM) -> dict:
    """For each k the best of ``n_init`` runs and its cost; all runs of all k share their passes."""
    own_cache = df.storageLevel == StorageLevel.NONE
    if own_cache:
        df = df.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        runs = KM.fit_runs(df, [(k, seed + i) for k in k_range for i in range(n_init)], features, 300, 1e-4, parallelism)
    finally:
        if own_cache:
            df.unpersist()
    best = {k: min((r for r in runs if r.k == k), key=lambda r: (r.cost, r.seed)) for k in k_range}
    return {k: (r, r.cost) for k, r in best.items()}


def select_k(df: DataFrame, key: str, k_range=K_RANGE, n_init: int = N_INIT_SEARCH,
             seed: int = SEED) -> tuple[int, list[dict]]:
    """Silhouette of all rows per k; arg-max, first k wins ties."""
    df = df.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    found = best_runs(df, k_range, n_init, seed)
    models = [found[k][0] for k in k_range]
    rows = KM.all_clusters(df, models)
    scores = [{"k": k, "silhouette": s, "cost": found[k][1]}
              for k, s in zip(k_range, K.silhouettes(rows, "features", "clusters", [len(m.centres) for m in models]))]
    df.unpersist()
    best = max(scores, key=lambda r: (r["silhouette"], -r["k"]))
    return best["k"], scores


@dataclass
class ClusterJob:
    k: int
    scores: list
    assignments: DataFrame
    profile: DataFrame
    top_lifts: DataFrame
    crosstab: DataFrame


def cluster_level(known: DataFrame, level: str = "ADS", key: str = "incident_key",
                  k_range=K_RANGE, n_init_search: int = N_INIT_SEARCH,
                  n_init_final: int = N_INIT_FINAL) -> ClusterJob:
    """The ADS job and the by-level job are one parameterised job."""
    flagged = N.ensure_narrative_flags(known)
    slice_df = flagged.where(F.col("automation_level") == level)
    n = slice_df.count()
    if n < MIN_ROWS:
        raise ValueError(f"automation_level {level!r}: {n} rows, need at least {MIN_ROWS}")
    tab = [f for f in S.CONTEXT_FEATURES if f in slice_df.columns and f != "automation_level"]
    X = cut_lineage(cluster_matrix(slice_df, tab + N.NAV_FEATURES))
    best_k, scores = select_k(X.select(key, "features"), key, k_range, n_init_search)
    model, _ = fit_kmeans(X, best_k, n_init_final)
    assigned = model.transform(X).drop("features")
    # cluster first, then the incident columns
    assigned = cut_lineage(assigned.select("cluster", *[c for c in assigned.columns if c != "cluster"]))
    prof = K.cluster_profile(assigned, "cluster", S.PROFILE_COLS, pct_name=f"pct_of_{level.lower()}")
    flags = [c for c in assigned.columns if c.startswith("nav_")]
    lift = K.flag_lift(assigned, "cluster", flags)
    labelled = K.scenario_labels(prof, lift, "cluster").withColumn("automation_level", F.lit(level))
    return ClusterJob(best_k, scores, assigned, labelled, K.top_lifts(lift, "cluster", 3),
                      K.crosstab(assigned, "cluster", "roadway_type"))


def pca_projection(df: DataFrame, features: str = "features", k: int = 2):
    """2-D PCA of the mean-centred matrix (I19): (projection frame, explained ratios).

    Spark's PCA projects without centring, so the input is centred first.
    """
    centred = StandardScaler(inputCol=features, outputCol="__c", withMean=True,
                             withStd=False).fit(df).transform(df)
    model = PCA(k=k, inputCol="__c", outputCol="__pc").fit(centred)
    proj = model.transform(centred).withColumn("__a", vector_to_array("__pc"))
    proj = proj.select("*", *[F.col("__a")[i].alias(f"pc{i + 1}") for i in range(k)]).drop(
        "__c", "__pc", "__a")
    return proj, list(model.explainedVariance.toArray())
