"""Classification metrics as aggregates.

Every metric is computed from counts produced by one pass over the predictions:
confusion counts are ``count_if`` aggregates (partial aggregation, no join), the
threshold sweep evaluates all grid points in the same pass, and ROC AUC counts ordered
pairs over radix slices of the distinct scores, never a global sort in one task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .groups import join_groups
from .prefix import ordered_pairs

# FIXED VALUES: threshold grid 0.20..0.80 step 0.02 and the precision floor
THRESHOLDS = [round(0.20 + 0.02 * i, 2) for i in range(31)]
PRECISION_FLOOR = 0.65


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def confusion_counts(df: DataFrame, label: str, pred: str, by: list[str] | None = None,
                     presence: bool = False) -> DataFrame:
    """TP/FP/FN/TN (F16), optionally per group. ``presence`` adds the label counts
    ``__pos`` / ``__neg`` from the same aggregate (see ``both_classes``)."""
    y, p = _c(label), _c(pred)
    aggs = [F.count_if((p == 1) & (y == 1)).alias("TP"),
            F.count_if((p == 1) & (y == 0)).alias("FP"),
            F.count_if((p == 0) & (y == 1)).alias("FN"),
            F.count_if((p == 0) & (y == 0)).alias("TN")]
    if presence:
        aggs += [F.count_if(y == 1).alias("__pos"), F.count_if(y == 0).alias("__neg")]
    return df.groupBy(*(by or [])).agg(*aggs)


def both_classes() -> Column:
    """Both label classes occur in the group (F14), on ``presence`` counts."""
    return (F.col("__pos") > 0) & (F.col("__neg") > 0)


def with_rates(counts: DataFrame, digits: int | None = 6) -> DataFrame:
    """precision / recall / F1 (0 on zero denominators) and FN rate (NULL on zero)."""
    tp, fp, fn = F.col("TP"), F.col("FP"), F.col("FN")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0))
    fnr = F.when(tp + fn > 0, fn / (tp + fn))
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return counts.withColumns({"precision": r(prec), "recall": r(rec), "f1": r(f1),
                               "fn_rate": r(fnr)})


def roc_auc(df: DataFrame, label: str, score: str, by: list[str] | None = None,
            digits: int | None = 6) -> DataFrame:
    """Rank (Mann-Whitney) ROC AUC with average ranks for ties.

    AUC = sum over distinct scores s of pos(s) * (neg(<s) + neg(s)/2) / (P * N).
    Scores are first reduced to one row per distinct value (so a heavily repeated
    score is one row), then pairs are counted slice by slice (``ordered_pairs``).
    NULL when a group has a single class.
    """
    by = list(by or [])
    hist = score_histogram(df.withColumn("__s", F.col(score).cast("double")), label, "__s", by)
    out = ordered_pairs(hist, by, "__s", "pos", "neg")
    auc = F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("pairs") / (F.col("pos").cast("double") * F.col("neg")))
    if digits is not None:
        auc = F.round(auc, digits)
    return out.select(*by, auc.alias("roc_auc"))


def score_histogram(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """(``by``, score, pos, neg): rows of each class at every score. It answers every threshold of
    every group, e.g. of all settings of a grid by a model column, in one pass over the scored rows."""
    y = F.col(label)
    return df.groupBy(*(by or []), score).agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))


def threshold_sweep(df: DataFrame, label: str, prob: str, thresholds=THRESHOLDS,
                    floor: float = PRECISION_FLOOR, by: list[str] | None = None,
                    digits: int | None = 6) -> DataFrame:
    """Evaluate every grid threshold in one aggregate and mark the chosen one.

    Choice: maximise (precision >= floor, F1, recall); the lowest threshold wins ties.
    Precision/recall use max(denominator, 1), as the reference's sweep does.
    """
    y = F.col(label)
    rows = df.select(*(by or []), prob, (y == 1).cast("long").alias("pos"), (y == 0).cast("long").alias("neg"))
    return sweep_histogram(rows, prob, thresholds, floor, by, digits)


def sweep_histogram(hist: DataFrame, prob: str, thresholds=THRESHOLDS, floor: float = PRECISION_FLOOR,
                    by: list[str] | None = None, digits: int | None = 6) -> DataFrame:
    """``threshold_sweep`` of a score histogram."""
    by = list(by or [])
    p = F.col(prob)
    aggs = []
    for i, t in enumerate(thresholds):
        hit = p >= F.lit(float(t))
        part = lambda side, c: F.coalesce(F.sum(F.when(side, F.col(c))), F.lit(0))
        aggs.append(F.struct(F.lit(float(t)).alias("threshold"),
                             part(hit, "pos").alias("TP"),
                             part(hit, "neg").alias("FP"),
                             part(~hit, "pos").alias("FN")).alias(f"__t{i}"))
    wide = hist.groupBy(*by).agg(*aggs)
    long = wide.select(*by, F.inline(F.array(*[F.col(f"__t{i}") for i in range(len(thresholds))])))
    tp, fp, fn = F.col("TP"), F.col("FP"), F.col("FN")
    prec = tp / F.greatest(tp + fp, F.lit(1))
    rec = tp / F.greatest(tp + fn, F.lit(1))
    long = long.withColumns({"precision": prec, "recall": rec})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    long = long.withColumn("f1", f1).withColumn(
        "meets_floor", (F.col("precision") >= F.lit(floor)).cast("int"))
    # 31 rows per group: the ranking window is bounded by the grid size
    w = Window.partitionBy(*by).orderBy(F.desc("meets_floor"), F.desc("f1"), F.desc("recall"),
                                        F.asc("threshold"))
    long = long.withColumn("chosen", (F.row_number().over(w) == 1).cast("int"))
    if digits is not None:
        long = long.withColumns({c: F.round(c, digits) for c in ("precision", "recall", "f1")})
    return long


def best_threshold(sweep: DataFrame) -> dict:
    """The chosen row of a (single-group) sweep, as a dict (31 rows scanned)."""
    r = sweep.where(F.col("chosen") == 1).first()
    return r.asDict() if r is not None else {}


def false_negatives(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Rows predicted 0 whose truth is 1."""
    return df.where((F.col(pred) == 0) & (F.col(label) == 1))


def evaluate(df: DataFrame, label: str, pred: str, score: str | None = None,
             by: list[str] | None = None, digits: int | None = 6,
             presence: bool = False) -> DataFrame:
    """Confusion counts + rates (+ AUC when a score is given) per group.

    With a score, all come from one histogram: rows are counted per (group, score) once, and
    counts and AUC are sums over it. ``presence`` keeps ``__pos`` / ``__neg``, so a caller can drop
    single-class groups (``both_classes()``) without another pass or a join.
    """
    by = list(by or [])
    if score is None:
        return with_rates(confusion_counts(df, label, pred, by, presence), digits)
    scored = df.select(*by, label, pred, F.col(score).cast("double").alias("__s"))
    hist = confusion_counts(scored, label, pred, [*by, "__s"], presence=True)
    kinds = ["TP", "FP", "FN", "TN"]
    sums = ordered_pairs(hist, by, "__s", "__pos", "__neg", kinds)
    out = with_rates(sums.select(*by, *(F.coalesce(c, F.lit(0)).alias(c) for c in [*kinds, "__pos", "__neg"]), "pairs"), digits)
    auc = F.when(both_classes(), F.col("pairs") / (F.col("__pos").cast("double") * F.col("__neg")))
    out = out.withColumn("roc_auc", F.round(auc, digits) if digits is not None else auc).drop("pairs")
    return out if presence else out.drop("__pos", "__neg")


def miss_summary(df: DataFrame, label: str, pred: str, by: list[str],
                 top_cols: dict[str, str]) -> DataFrame:
    """Per group: severe total, FN, FN rate (denominator max(n,1)) and the most common
    value of each ``top_cols`` column among the misses ('N/A' when none) (F9)."""
    y, p = F.col(label), F.col(pred)
    base = df.groupBy(*by).agg(F.count_if(y == 1).alias("total_severe"),
                               F.count_if((p == 0) & (y == 1)).alias("FN"))
    base = base.withColumn("fn_rate", F.round(F.col("FN") / F.greatest(F.col("total_severe"),
                                                                      F.lit(1)), 6))
    fn = false_negatives(df, label, pred)
    from .clusters import group_modes
    tops = group_modes(fn, by, list(top_cols))
    base = join_groups(base, tops.select(*by, *[F.col(f"{c}__value").alias(o) for c, o in top_cols.items()]),
                       by, "left")
    return base.fillna({v: "N/A" for v in top_cols.values()})
