"""Distributed prefix sums, medians, AUC and the threshold sweep against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from sevscope.operators import metrics as M
from sevscope.operators.prefix import exact_medians, ordered_code, ordered_pairs


def _auc_brute(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    if not pos or not neg:
        return None
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_ordered_code(spark):
    """Codes sort as the numbers do and differ where they differ, from the smallest to infinity."""
    rng = np.random.default_rng(7)
    vals = [0.0, 5e-324, 1e-310, 2.2250738585072014e-308, 1.0, 1.0000000000000002, 0.1, 3.0, 1e300, 1.7976931348623157e308, float("inf")]
    vals += rng.standard_normal(500).tolist() + np.exp(rng.uniform(-700, 700, 500)).tolist()
    vals = sorted({x for v in vals for x in (v, -v)})
    df = spark.createDataFrame([(v,) for v in vals] + [(None,), (float("nan"),), (-0.0,)], "v double")
    got = [r.c for r in df.select(ordered_code("v").alias("c")).collect()]
    codes, (null, nan, zero) = got[:-3], got[-3:]
    assert codes == sorted(set(codes)) and null < codes[0] and nan > codes[-1] and zero == codes[vals.index(0.0)]


@pytest.mark.parametrize("bits", [16, 8])
def test_ordered_pairs(spark, bits):
    """Pairs in order per group, NULL among the groups and the values, against all pairs."""
    rng = np.random.default_rng(1)
    near = lambda a, b: sum(p * n * ((x > y) + 0.5 * (x == y)) for x, p, _ in a for y, _, n in b)
    groups = {None: [(float(v), int(p), int(n)) for v, p, n in zip(rng.standard_normal(150), rng.integers(0, 5, 150), rng.integers(0, 5, 150))],
              "narrow": [(1.0 + i * 2.0 ** -52, 1, 2) for i in range(60)], "one": [(0.5, 3, 4)], "signs": [(-2.0, 1, 0), (-1.0, 0, 2), (0.0, 3, 1), (2.5, 2, 2)]}
    df = spark.createDataFrame([(g, v, p, n, 1) for g, own in groups.items() for v, p, n in own] + [("signs", None, 1, 5, 1)],
                               "g string, v double, p long, n long, c long")
    groups["signs"].append((-float("inf"), 1, 5))  # NULL sorts first
    got = {r.g: (r.p, r.n, r.c, r.pairs) for r in ordered_pairs(df, ["g"], "v", "p", "n", ["c"], bits).collect()}
    assert got == {g: (sum(x[1] for x in own), sum(x[2] for x in own), len(own), near(own, own)) for g, own in groups.items()}
    assert ordered_pairs(df.where("false"), ["g"], "v", "p", "n").count() == 0


@pytest.mark.parametrize("bits", [16, 8])
def test_exact_medians(spark, bits):
    vals = [5.0, 1.0, 3.0, 3.0, None, 8.0, 2.0]
    df = spark.createDataFrame([(v, None if v is None else v * 2, None) for v in vals],
                               "a double, b double, c double")
    med = exact_medians(df, ["a", "b", "c"], bits)
    assert med["a"] == np.median([v for v in vals if v is not None])
    assert med["b"] == np.median([2 * v for v in vals if v is not None])
    assert med["c"] is None
    rng = np.random.default_rng(2)
    wide = np.concatenate([rng.standard_normal(301), 1.0 + np.arange(300) * 2.0 ** -52, np.repeat(-7.25, 100)])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(wide, 1.0 + rng.permutation(701) * 2.0 ** -52)], "a double, b double")
    assert exact_medians(df, ["a", "b"], bits) == {c: float(np.median([r[c] for r in df.collect()])) for c in "ab"}


def test_no_job_while_a_query_is_built(spark):
    """Medians and AUC are plans: building them starts no job."""
    from sevscope.operators.prefix import medians
    df = spark.createDataFrame([(i % 2, float(i)) for i in range(50)], "y int, s double")
    seen = lambda: spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("building", "")
    try:
        frames = [M.roc_auc(df, "y", "s"), M.evaluate(df, "y", "y", "s"), medians(df, ["s"])]
        assert not seen()
        assert frames[2].first()["median"] == 24.5 and seen()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_auc_ties_single_class_perfect_inverted(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 200).tolist()
    s = (rng.integers(0, 10, 200) / 10).tolist()  # many ties
    cases = {"ties": (y, s), "perfect": ([0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9]),
             "inverted": ([1, 1, 0, 0], [0.1, 0.2, 0.8, 0.9]), "single": ([1, 1, 1], [0.2, 0.5, 0.9])}
    rows = [(k, int(a), float(b)) for k, (ys, ss) in cases.items() for a, b in zip(ys, ss)]
    df = spark.createDataFrame(rows, "case string, y int, s double")
    got = {r.case: r.roc_auc for r in M.roc_auc(df, "y", "s", ["case"], digits=None).collect()}
    for k, (ys, ss) in cases.items():
        exp = _auc_brute(ys, ss)
        assert (got[k] is None) if exp is None else got[k] == pytest.approx(exp, abs=1e-12)


def test_threshold_sweep_rules(spark):
    # every threshold gives the same counts -> the lowest threshold wins
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "y int, p double")
    sw = M.threshold_sweep(df, "y", "p")
    assert M.best_threshold(sw)["threshold"] == 0.2
    # no threshold meets the precision floor -> best F1 among all
    df2 = spark.createDataFrame([(1, 0.9), (0, 0.95), (0, 0.85), (1, 0.3)], "y int, p double")
    best = M.best_threshold(M.threshold_sweep(df2, "y", "p"))
    assert best["meets_floor"] == 0 and best["threshold"] == 0.2
    # no positives: precision/recall 0, still a choice
    df3 = spark.createDataFrame([(0, 0.9), (0, 0.1)], "y int, p double")
    assert M.threshold_sweep(df3, "y", "p").where("chosen = 1").count() == 1
    assert M.threshold_sweep(df3, "y", "p").count() == 31


def test_confusion_sums_and_rates(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "y int, p int")
    r = M.evaluate(df, "y", "p").first()
    assert r.TP + r.FP + r.FN + r.TN == 5
    assert (r.precision, r.recall, r.fn_rate) == (0.5, 0.5, 0.5)
    z = M.evaluate(spark.createDataFrame([(0, 0)], "y int, p int"), "y", "p").first()
    assert (z.precision, z.recall, z.f1, z.fn_rate) == (0.0, 0.0, 0.0, None)
