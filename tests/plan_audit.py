"""Physical-plan audit of the query catalogue -> PLANS.md.

For each query: number of shuffles (Exchange), join strategies, window and
aggregate operators, and any operator that would be a red flag at scale
(cartesian / nested-loop joins, row-at-a-time Python evaluation).

Usage: python tests/plan_audit.py [sf_dir] [query ...]
"""
from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

WATCH = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "HashAggregate", "SortAggregate",
         "ObjectHashAggregate", "TakeOrderedAndProject", "BatchEvalPython", "ArrowEvalPython",
         "MapInPandas", "FlatMapGroupsInPandas", "Expand", "Generate", "FileScan", "Scan parquet"]
RED = {"BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython"}
# fitted-model / sampling queries run many small jobs; their plans are not single queries
SKIP = {"stratified_models", "best_per_level", "importances", "boosted_fit", "ablation",
        "nav_coefficients", "pooled_vs_stratified", "kmeans_select_k", "cluster_job",
        "cluster_job_l2", "pca_projection", "pooled_baseline", "coefficients", "lr_false_negatives"}


def plan_text(df) -> str:
    df.collect()  # let AQE settle the final plan
    txt = df._jdf.queryExecution().executedPlan().toString()
    return txt.split("== Initial Plan ==")[0]


def summarise(txt: str) -> Counter:
    c = Counter()
    for line in txt.splitlines():
        for op in WATCH:
            if re.search(rf"\b{re.escape(op)}\b", line):
                if op == "Exchange" and ("BroadcastExchange" in line or "ReusedExchange" in line):
                    continue
                c[op] += 1
    return c


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as E
    qs = E.queries()
    rows = []
    for n in names or [q for q in qs if q not in SKIP]:
        c = summarise(plan_text(qs[n](spark, sf_dir)))
        flags = sorted(op for op in RED if c.get(op))
        rows.append((n, c, flags))
        print(n, dict(c), flags, flush=True)
    cols = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "Window",
            "HashAggregate", "SortAggregate", "ObjectHashAggregate", "TakeOrderedAndProject",
            "Expand", "ArrowEvalPython", "MapInPandas"]
    out = ["# Physical-plan audit (final AQE plans at sf0.01, generated by tests/plan_audit.py)", "",
           "Counts of operators in each catalogue query's executed plan. Red flags "
           "(cartesian / nested-loop joins, row-at-a-time Python UDFs): "
           + ("none." if not any(f for _, _, f in rows) else "see last column."), "",
           "| query | " + " | ".join(cols) + " | red flags |",
           "|---|" + "---|" * (len(cols) + 1)]
    for n, c, f in rows:
        out.append(f"| {n} | " + " | ".join(str(c.get(k, 0)) for k in cols) + f" | {', '.join(f) or '-'} |")
    out += ["", "Fitted-model queries (" + ", ".join(sorted(SKIP)) + ") are driver loops over "
            "distributed `pyspark.ml` fits and are not single plans."]
    if not names:
        with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
            fh.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main(sys.argv)
