"""Mergeable profiles: parts merged against one pass and exact values."""
from pyspark.sql import functions as F

from sevscope.operators import profile as P


def _read(df):
    return {r.column_name: r for r in P.read_profile(df).collect()}


def test_merged_parts_agree_with_one_pass_and_exact_values(spark):
    df = spark.range(30_000).selectExpr(
        "id", "cast(id % 700 as string) as word", "if(id % 3 = 0, null, id / 7.0D) as x", "cast(null as double) as none",
        "if(id % 2 = 0, double('NaN'), 5.0D) as odd", "'a' as `with.dot`")
    once = _read(P.profile_sketches(df))
    parts = None
    for k in range(5):
        part = P.profile_sketches(df.where(F.col("id") % 5 == k))
        parts = part if parts is None else parts.unionAll(part)
    merged = _read(P.merge_profiles(parts))
    exact = {c: df.agg(F.count_distinct(F.col(f"`{c}`").cast("string"))).first()[0] for c in df.columns}
    assert set(once) == set(merged) == set(df.columns)
    for c in df.columns:
        assert (merged[c].n, merged[c].n_nonnull) == (once[c].n, once[c].n_nonnull) == (30_000, df.where(F.col(f"`{c}`").isNotNull()).count())
        for got in (once[c].n_unique, merged[c].n_unique):
            assert abs(got - exact[c]) <= max(1, 5 * P.DISTINCT_ERROR * exact[c])
    for got in (once["x"].median, merged["x"].median):
        rank = df.where(F.col("x") <= got).count() / once["x"].n_nonnull
        assert abs(rank - 0.5) <= P.RANK_ERROR + 1e-3
    assert once["odd"].median == merged["odd"].median == 5.0
    assert merged["none"].median is None and merged["word"].median is None and merged["none"].n_unique == 0


def test_profile_of_an_empty_table_and_of_a_column_in_some_parts(spark):
    a = P.profile_sketches(spark.range(0).selectExpr("id", "cast(id as string) as t"))
    b = P.profile_sketches(spark.range(4).selectExpr("id"))
    got = _read(P.merge_profiles(a.unionAll(b)))
    assert (got["id"].n, got["id"].n_unique) == (4, 4) and got["id"].median in (1.0, 2.0)
    assert (got["t"].n, got["t"].n_unique, got["t"].median) == (0, 0, None)
