import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from sevscope.operators import kmeans as KM
from sevscope.operators.draws import Draws
from sevscope.plans import cleaning as C
from sevscope.plans import clustering as CL
from sevscope.plans import models as MO
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (600, 6)) * rng.normal(1, 1, 6)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, x array<double>")
    return df.select("id", array_to_vector("x").alias("features")).repartition(3).persist()


def test_runs_end_as_spark_ends_them(points, monkeypatch):
    monkeypatch.setattr(KM, "BLOCK_BYTES", 1000)  # many blocks, many products
    monkeypatch.setattr(KM, "CELLS", 50)
    for got in KM.fit_runs(points, [(2, 42), (5, 42), (5, 43)]):
        one = KMeans(k=got.k, seed=got.seed, featuresCol="features", initMode="k-means||", maxIter=300, tol=1e-4).fit(points)
        assert np.allclose(np.stack(one.clusterCenters()), got.centres)
        assert got.cost == pytest.approx(one.summary.trainingCost)
        own = {r.id: r.cluster for r in got.transform(points).collect()}
        assert own == {r.id: r.prediction for r in one.transform(points).collect()}


def test_one_job_a_round_for_all_runs(points, monkeypatch):
    rounds = []
    run = KM.lloyd

    def lloyd(blocks, runs, max_iter, tol):
        rounds.append(len(runs))
        return run(blocks, runs, max_iter, tol)
    monkeypatch.setattr(KM, "lloyd", lloyd)
    best, scores = CL.select_k(points, "id", [2, 3], n_init=2)
    assert rounds == [4] and [s["k"] for s in scores] == [2, 3] and best in (2, 3)


def test_fewer_rows_than_centres(spark):
    df = spark.createDataFrame([([0.0, 1.0],), ([0.0, 1.0],), ([5.0, 1.0],)], "x array<double>").select(array_to_vector("x").alias("features"))
    (run,) = KM.fit_runs(df, [(3, 42)])
    assert sorted(c.tolist() for c in np.unique(run.centres, axis=0)) == [[0.0, 1.0], [5.0, 1.0]] and run.cost == 0.0


def test_flagged_table_of_some_columns(spark, monkeypatch):
    monkeypatch.setattr(C, "_FLAGGED", {})
    monkeypatch.setattr(C, "_CLEANED", {})
    lazy = C.flagged_known(spark, SF_SMALL, ["roadway_type"], written=False)
    few = C.flagged_known(spark, SF_SMALL, ["roadway_type"])
    assert "narrative" not in few.columns and "weather_rain" not in few.columns and "crash_with" not in few.columns
    assert sorted(lazy.columns) == sorted(few.columns)
    assert C.flagged_known(spark, SF_SMALL, [], written=False) is few
    every = C.flagged_known(spark, SF_SMALL).select(*few.columns)
    assert few.count() == every.count() == lazy.count() > 0
    assert few.exceptAll(every).isEmpty() and lazy.select(*few.columns).exceptAll(every).isEmpty()


def test_matrices_hold_vector_and_label_alone(spark, monkeypatch):
    written = []
    monkeypatch.setattr(MO, "cut_lineage", lambda df, name="lineage": written.append(df.columns) or df)
    rows = [(f"k{i}", "archived" if i % 2 else "current", "ADS", "x" * 200, float(i % 7), i // 2 % 2) for i in range(40)]
    known = spark.createDataFrame(rows, "incident_key string, era string, automation_level string, narrative string, sv_speed_mph double, severe int")
    m = MO._matrices(known, ["sv_speed_mph"])
    assert written == [["features", "severe"]] * 3 and m.test.columns == ["features", "severe"]


def test_draws_are_those_of_the_sampler(spark):
    seeds = [42, -7, 2**31 - 1, 0]
    draws = Draws(seeds)
    got = np.concatenate([draws.take(n) for n in (1, 4_999, 5, 200)], axis=1)
    for seed, numbers in zip(seeds, got):
        own = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        places = [*range(20), *range(4_060, 4_130), 5_200]
        assert [numbers[i] for i in places if i < 5_205] == [n for i, n in enumerate(own.nextDouble() for _ in range(5_205)) if i in places]


def test_starting_centres_of_all_runs_in_few_jobs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    values = rng.integers(0, 5, (900, 3)) * np.array([0.3, 0.7, 1.1])  # many equally near rows
    some = [(Vectors.sparse(12, {int(c): 1.9, 6: float(v[0]), 7: float(v[1]), 8: float(v[2])}),) for c, v in zip(rng.integers(0, 6, 900), values)]
    rows = spark.createDataFrame(some, T.StructType([T.StructField("features", VectorUDT())])).repartition(3).persist()
    runs = [(k, seed) for k in (2, 3, 6) for seed in (1, 42, 99)]
    ran = []
    monkeypatch.setattr(KM, "lloyd", lambda blocks, begun, *rest: ran.append(blocks) or begun)
    rows.count()
    spark.sparkContext.setJobGroup("starting centres", "")
    begun = KM.fit_runs(rows, runs, parallelism=1)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("starting centres"))
    spark.sparkContext.setJobGroup("others", "")
    for got in begun:
        one = KMeans(k=got.k, seed=got.seed, featuresCol="features", maxIter=0).fit(rows)
        assert np.allclose(np.stack(one.clusterCenters()), got.centres)
    assert len(ran) == 1 and jobs < 3 * len(runs)  # Spark's fits take at least seven each
