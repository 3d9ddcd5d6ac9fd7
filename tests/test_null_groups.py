"""NULL groups, white space and wide vocabularies against plain counts."""
import hashlib

import pytest
from pyspark.sql import functions as F

from sevscope.functions import flags
from sevscope.operators import clusters, metrics, profile, splits
from sevscope.session import ensure_checkpoint_dir


def frame(spark):
    g = F.when(F.col("id") % 4 == 0, None).otherwise(F.concat(F.lit("g"), F.col("id") % 3))
    return spark.range(1000).select("id", F.col("id").cast("string").alias("key"), g.alias("g"), (F.col("id") % 5 == 0).cast("int").alias("y"),
                                    (F.col("id") % 7 / 7.0).alias("p"), (F.col("id") % 7 > 3).cast("int").alias("hat"), (F.col("id") % 11).cast("string").alias("v"))


def test_split_keeps_every_row(spark):
    df = frame(spark)
    out = splits.stratified_random(df, ["g"], "key", 0.2)
    assert out.count() == 1000
    for r in out.groupBy("g").agg(F.count("*").alias("n"), F.sum("is_test").alias("t")).collect():
        assert r.t == round(0.2 * r.n)


def test_metrics_keep_the_null_group(spark):
    df = frame(spark)
    want = {r.g: r for r in metrics.evaluate(df, "y", "hat", by=["g"]).collect()}
    got = {r.g: r for r in metrics.evaluate(df, "y", "hat", "p", by=["g"]).collect()}
    assert set(got) == set(want) and None in got and all(got[g].TP == want[g].TP for g in got)
    alone = metrics.roc_auc(df.where("g is null"), "y", "p").first()[0]
    assert got[None].roc_auc == pytest.approx(alone)
    tops = {r.g: r.top for r in metrics.miss_summary(df, "y", "hat", ["g"], {"v": "top"}).collect()}
    assert None in tops and tops[None] != "N/A"


def test_top_categories_keep_the_null_group(spark):
    got = profile.top_categories(frame(spark), "v", 2, by=["g"]).collect()
    assert {r.g for r in got} == {None, "g0", "g1", "g2"} and len(got) == 8


def test_crosstab_of_a_wide_vocabulary(spark):
    df = spark.range(40_000).select((F.col("id") % 2).cast("int").alias("c"), F.when(F.col("id") % 10 != 9, F.concat(F.lit("v"), F.col("id") % 20_000)).alias("v"))
    got = clusters.crosstab(df, "c", "v")
    assert got.count() == 2 * 18_000 and got.agg(F.sum("n")).first()[0] == 36_000
    assert got.where("v is null or v = 'null'").count() == 0


def test_silhouette_takes_all_rows(spark):
    from pyspark.ml.functions import array_to_vector
    df = spark.range(5000).select((F.col("id") % 3).cast("int").alias("c"), array_to_vector(F.array((F.col("id") % 3 * 10 + F.rand(1)), F.rand(2))).alias("f"))
    got = clusters.silhouette(df, "f", "c").collect()
    assert sum(r.n for r in got) == 5000 and all(r.silhouette > 0.98 for r in got)


def test_all_white_space_is_stripped(spark):
    df = spark.createDataFrame([("Yes\t", "Minor\n", "\t", "r1"), ("\nNO", "\x0bFatality\r", "k", "r2")], "y string, i string, s string, r string")
    got = df.select(flags.yes_flag("y"), flags.injury_rank("i"), flags.incident_key("s", "r")).collect()
    assert [r[0] for r in got] == [1.0, 0.0] and None not in [r[1] for r in got]
    assert [r[2] for r in got] == ["SINGLE_r1", "k"]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


@pytest.mark.parametrize("share", [0.0, 0.3, 1.0])
def test_split_equals_plain_ranking(spark, share):
    df = frame(spark)
    out = {r.key: (r.g, r.is_test) for r in splits.stratified_random(df, ["g"], "key", share).collect()}
    for g in {x for x, _ in out.values()}:
        keys = sorted((k for k in out if out[k][0] == g), key=lambda k: (int(hashlib.md5(f"{k}:42".encode()).hexdigest()[:15], 16), k))
        assert [out[k][1] for k in keys] == [int(i < round(share * len(keys))) for i in range(len(keys))]
