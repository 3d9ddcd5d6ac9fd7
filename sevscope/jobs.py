"""Batch steps with result-table outputs, one per stage of the reference's workflow.

    python -m sevscope.jobs clean      --raw-csv-dir DIR | --sf-dir DIR  --out OUT
    python -m sevscope.jobs baselines  --out OUT
    python -m sevscope.jobs stratified --out OUT [--refit-on-full]
    python -m sevscope.jobs narrative  --out OUT
    python -m sevscope.jobs misses     --out OUT
    python -m sevscope.jobs cluster    --out OUT [--level ADS]
    python -m sevscope.jobs explore    --out OUT

``clean`` writes ``OUT/cleaned`` (parquet partitioned by era, level), the labelled
incidents with their narrative flags as ``OUT/flagged`` (same layout) and the data
dictionary; every later step reads ``OUT/flagged``, as the reference's later scripts
read its cleaned file (and re-derive the flags), and writes its result tables under
``OUT/results``.
"""
from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import narrative as N
from .operators import profile as P
from .plans import cleaning as C
from .plans import clustering as CL
from .plans import models as MO
from .session import drop_stages, get_spark
from .sources import extracts as X
from .sources import fixtures, sinks

# Raw extract layout of the reference's inputs: (file, encoding, level, era), in order.
# (a path may be a file or a folder of CSV parts)
DEFAULT_EXTRACTS = [("ADS_current", "UTF-8", "ADS", "current"),
                    ("L2_current", "UTF-8", "L2", "current"),
                    ("ADS_archived", "UTF-8", "ADS", "archived"),
                    ("L2_archived", "ISO-8859-1", "L2", "archived")]


def _results(out: str, name: str) -> str:
    return os.path.join(out, "results", name)


def rows_to_df(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Small driver-side result rows (metrics, coefficients) -> DataFrame with a
    declared schema (int / double / string / boolean per key, NULL-tolerant)."""
    keys = []
    for r in rows:
        keys += [k for k, v in r.items() if k not in keys and not isinstance(v, (list, dict))]

    def kind(k):
        vals = [r.get(k) for r in rows if r.get(k) is not None]
        if vals and all(isinstance(v, bool) for v in vals):
            return "boolean"
        if vals and all(isinstance(v, int) and not isinstance(v, bool) for v in vals):
            return "bigint"
        if vals and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in vals):
            return "double"
        return "string"
    kinds = {k: kind(k) for k in keys}
    conv = {"bigint": int, "double": float, "boolean": bool, "string": str}
    data = [tuple(None if r.get(k) is None else conv[kinds[k]](r.get(k)) for k in keys) for r in rows]
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    return spark.createDataFrame(data, schema)


def _write_rows(spark: SparkSession, rows: list[dict], path: str) -> None:
    if rows:
        sinks.write_result(rows_to_df(spark, rows), path)


def step_clean(spark: SparkSession, out: str, sf_dir: str | None = None,
               raw_csv_dir: str | None = None) -> DataFrame:
    """Raw extracts -> cleaned incidents + data dictionary (reference step 1)."""
    if raw_csv_dir:
        ex = [X.Extract(os.path.join(raw_csv_dir, f), enc, lvl, era)
              for f, enc, lvl, era in DEFAULT_EXTRACTS]
        raw = X.read_extracts(spark, ex)
        # real files: equal versions resolve by source order, then by file content
        tiebreak = ["source_ord"]
    else:
        raw = fixtures.raw_reports(spark, sf_dir)
        tiebreak = fixtures.TIEBREAK_COLS
    res = C.clean(raw, tiebreak)
    sinks.write_cleaned(res.table, os.path.join(out, "cleaned"))
    table = sinks.read_cleaned(spark, os.path.join(out, "cleaned"))
    # the labelled incidents with their 22 narrative flags, written once; every later
    # step reads this table instead of re-running the regexes
    sinks.write_cleaned(N.attach_narrative_flags(C.load_known(table)), os.path.join(out, "flagged"))
    sinks.write_result(P.data_dictionary(table, "incident_key"), _results(out, "data_dictionary"))
    return table


def _known(spark: SparkSession, out: str) -> DataFrame:
    """Labelled incidents with their narrative flags (written by the clean step)."""
    return sinks.read_cleaned(spark, os.path.join(out, "flagged"), known_only=True)


def step_baselines(spark: SparkSession, out: str) -> None:
    """Pooled LR metrics, coefficients and missed severe rows (reference step 2)."""
    metrics, coefs, fn = MO.pooled_baseline(_known(spark, out))
    sinks.write_result(metrics, _results(out, "baseline_results"))
    _write_rows(spark, coefs, _results(out, "lr_coefficients"))
    sinks.write_result(fn.drop("features", "rawPrediction", "probability", "prediction", "weight"),
                       _results(out, "false_negatives"))


def step_stratified(spark: SparkSession, out: str, refit_on_full: bool = False) -> None:
    """LR / RF / boosted per level with thresholds from validation (reference step 3)."""
    res, tables = MO.stratified_models(_known(spark, out), refit_on_full=refit_on_full)
    _write_rows(spark, res, _results(out, "all_stratified_results"))
    _write_rows(spark, MO.best_per_level(res), _results(out, "stratified_by_level_results"))
    for name, rows in tables.items():
        _write_rows(spark, rows, _results(out, f"{name}_{'coefficients' if name.startswith('lr') else 'importances'}"))


def step_narrative(spark: SparkSession, out: str) -> None:
    """Flag prevalence and tabular-vs-narrative comparisons (reference step 4)."""
    known = _known(spark, out)
    flagged = N.ensure_narrative_flags(known)
    sinks.write_result(P.flag_prevalence(flagged, N.NAV_FEATURES, N.NAV_DESCRIPTIONS),
                       _results(out, "narrative_feature_descriptions"))
    runs = MO.ablation(known)
    _write_rows(spark, [r for r in runs if r["model"].startswith("ADS")],
                _results(out, "narrative_ads_model_comparison"))
    _write_rows(spark, [r for r in runs if r["model"].startswith("Pooled")],
                _results(out, "narrative_pooled_model_comparison"))
    nav = [c for r in runs for c in r.get("nav_coefficients", [])]
    _write_rows(spark, nav, _results(out, "narrative_coefficients"))


def step_misses(spark: SparkSession, out: str) -> None:
    """Fixed-parameter refits and their missed severe cases (reference step 5)."""
    summary, misses = MO.fixed_refit_misses(_known(spark, out))
    sinks.write_result(summary, _results(out, "fn_summary"))
    for name, fn in misses.items():
        tag = "fn_xgb_ads" if "ADS" in name else "fn_lr_l2"
        sinks.write_result(fn, _results(out, tag))


def step_cluster(spark: SparkSession, out: str, level: str = "ADS",
                 n_init_search: int = CL.N_INIT_SEARCH, n_init_final: int = CL.N_INIT_FINAL) -> None:
    """Scenario clustering for one automation level (reference steps 6 and 6b)."""
    job = CL.cluster_level(_known(spark, out), level, n_init_search=n_init_search,
                           n_init_final=n_init_final)
    prefix = level.lower().replace(" ", "_")
    sinks.write_result(job.assignments, _results(out, f"{prefix}_cluster_assignments"))
    sinks.write_result(job.profile, _results(out, f"{prefix}_cluster_summary"))
    sinks.write_result(job.top_lifts, _results(out, f"{prefix}_cluster_top_lifts"))
    sinks.write_result(job.crosstab, _results(out, f"{prefix}_cluster_roadway_crosstab"))
    _write_rows(spark, job.scores, _results(out, f"{prefix}_silhouette_by_k"))


def step_explore(spark: SparkSession, out: str) -> None:
    """Exploratory k-means + 2-D PCA on the context features (figure tables)."""
    from .operators import features as FE
    known = _known(spark, out)
    spec = FE.fit_features(known, MO.context_features(known))
    X_ = CL.cut_lineage(spec.transform(known).select("incident_key", "features"))
    best, scores = CL.select_k(X_, "incident_key", CL.EXPLORE_K_RANGE)
    model, _ = CL.fit_kmeans(X_, best, CL.N_INIT_SEARCH)
    proj, ratio = CL.pca_projection(model.transform(X_))
    sinks.write_result(proj.select("incident_key", "cluster", "pc1", "pc2"), _results(out, "pca_projection"))
    _write_rows(spark, scores, _results(out, "explore_silhouette_by_k"))
    _write_rows(spark, [{"component": i + 1, "explained_ratio": float(x)} for i, x in enumerate(ratio)],
                _results(out, "explore_pca_ratio"))
    strata = (known.groupBy("era", "automation_level")
                   .agg(F.count(F.lit(1)).alias("n"), F.avg("severe").alias("severe_rate")))
    sinks.write_result(strata, _results(out, "severe_rate_by_stratum"))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m sevscope.jobs")
    ap.add_argument("step", choices=["clean", "baselines", "stratified", "narrative", "misses",
                                     "cluster", "explore"])
    ap.add_argument("--out", required=True)
    ap.add_argument("--sf-dir")
    ap.add_argument("--raw-csv-dir")
    ap.add_argument("--level", default="ADS")
    ap.add_argument("--refit-on-full", action="store_true")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    try:
        run_step(spark, a)
    finally:
        drop_stages(spark)  # results are in --out; nothing reads this run's stage tables again


def run_step(spark: SparkSession, a) -> None:
    if a.step == "clean":
        step_clean(spark, a.out, a.sf_dir, a.raw_csv_dir)
    elif a.step == "baselines":
        step_baselines(spark, a.out)
    elif a.step == "stratified":
        step_stratified(spark, a.out, a.refit_on_full)
    elif a.step == "narrative":
        step_narrative(spark, a.out)
    elif a.step == "misses":
        step_misses(spark, a.out)
    elif a.step == "cluster":
        step_cluster(spark, a.out, a.level)
    else:
        step_explore(spark, a.out)


if __name__ == "__main__":
    main()
