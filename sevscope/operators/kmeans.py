"""Many k-means runs over one matrix, all in one pass a round.

Every run (a number of clusters and a seed) starts from the centres that Spark's ``KMeans`` chooses for it (k-means||),
found for all runs in the same few passes. The rounds are shared, too: a pass over blocks of rows takes the nearest centres of all runs that still move in one matrix
product, and a sum, a count and a cost per centre come back, as many numbers as the centres have. Rounds end as in Spark: a
run stops when no centre moves by more than ``tol``, centres without rows stay, and its cost is that of its last round.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .draws import Draws

#: Bytes of a block of rows, and cells (rows times centres) of one matrix product.
BLOCK_BYTES, CELLS = 1 << 18, 1 << 18
#: Steps in which starting centres are taken (``KMeans.initSteps``).
STEPS = 2
#: Centres whose distances differ by less, as a part of the squares, may be equally near.
TIED = 1e-10


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest centre (the first of equals), and all squared distances less the row's own square."""
    d = (centres * centres).sum(1) - 2.0 * (x @ centres.T)
    return d.argmin(1), d


def matrix(x: pa.Array, width: int) -> np.ndarray:
    """The rows of an array of lists of ``width`` numbers."""
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class KMeansRun:
    k: int
    seed: int
    centres: np.ndarray
    cost: float = float("inf")

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, df: DataFrame, features: str = "features", out: str = "cluster") -> DataFrame:
        """``df`` with the number of its nearest centre."""
        sent = df.sparkSession.sparkContext.broadcast(self.centres)

        @F.arrow_udf("int")
        def cluster(x: pa.Array) -> pa.Array:
            centres = sent.value
            return pa.array(nearest(matrix(x, centres.shape[1]), centres)[0].astype("int32"))
        return df.withColumn(out, cluster(vector_to_array(features)))


def all_clusters(df: DataFrame, runs: list[KMeansRun], features: str = "features", out: str = "clusters") -> DataFrame:
    """``df`` with the numbers of its nearest centres, one for each run."""
    sent = df.sparkSession.sparkContext.broadcast([r.centres for r in runs])

    @F.arrow_udf("array<int>")
    def clusters(x: pa.Array) -> pa.Array:
        rows = matrix(x, sent.value[0].shape[1])
        at = np.stack([nearest(rows, c)[0] for c in sent.value], axis=1).astype("int32")
        return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype="int32") * at.shape[1]), pa.array(at.ravel()))
    return df.withColumn(out, clusters(vector_to_array(features)))


def row_blocks(df: DataFrame, features: str, width: int) -> RDD:
    """The vectors of ``df`` as blocks of rows, doubles in C order."""
    rows = max(1, BLOCK_BYTES // (8 * width))

    def cut(batches):
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype("float64").tobytes()
            parts = [x[i:i + 8 * width * rows] for i in range(0, len(x), 8 * width * rows)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], names=["block"])
    blocks = df.select(vector_to_array(features).alias("x")).mapInArrow(cut, "block binary")
    return blocks.rdd.map(lambda r: bytes(r[0]))


def _chunks(blocks, width: int, centres: int):
    """Rows of ``blocks``, as many at once as a product with ``centres`` may take."""
    step = max(1, CELLS // max(1, centres))
    for block in blocks:
        rows = np.frombuffer(block).reshape(-1, width)
        yield from (rows[i:i + step] for i in range(0, len(rows), step))


def _round(blocks, centres: np.ndarray, starts: list[int]):
    """(sum and count of every centre's rows, cost of every run) of one task's blocks."""
    width = centres.shape[1]
    sums, counts, costs = np.zeros_like(centres), np.zeros(len(centres)), np.zeros(len(starts))
    sizes = np.diff([*starts, len(centres)]).tolist()
    alike = []  # neighbours of as many centres: (first run, runs, centres of one)
    for r, k in enumerate(sizes):
        if alike and alike[-1][2] == k:
            alike[-1][1] += 1
        else:
            alike.append([r, 1, k])
    norms, twice = (centres * centres).sum(1)[:, None], -2.0 * centres
    for x in _chunks(blocks, width, len(centres)):
        own = (x * x).sum(1)
        d = twice @ x.T
        d += norms
        for r, n, k in alike:
            part = d[starts[r]:starts[r] + n * k].reshape(n, k, len(x))
            best = part.min(1) if k > 8 else part[:, 0].copy()
            for j in range(1, k if k <= 8 else 1):
                np.minimum(best, part[:, j], out=best)
            chosen = part == best[:, None]
            if np.count_nonzero(chosen) > best.size:  # the first of equals
                chosen &= np.cumsum(chosen, 1) == 1
            best += own
            costs[r:r + n] += np.maximum(best, 0.0, out=best).sum(1)
            part[...] = chosen
        sums += d @ x
        counts += d.sum(1)
    yield sums, counts, costs


def _added(a, b):
    return tuple(x + y for x, y in zip(a, b))


def lloyd(blocks: RDD, runs: list[KMeansRun], max_iter: int, tol: float) -> list[KMeansRun]:
    """``runs`` after their rounds over ``blocks``; one Spark job a round, whatever the number of runs."""
    live, done = list(runs), 0
    while live and done < max_iter:
        starts = np.cumsum([0, *[len(r.centres) for r in live[:-1]]]).tolist()
        sent = blocks.context.broadcast(np.concatenate([r.centres for r in live]))
        sums, counts, costs = blocks.mapPartitions(lambda b, s=sent, at=starts: _round(b, s.value, at)).treeReduce(_added)
        sent.unpersist()
        moving = []
        for r, a, cost in zip(live, starts, costs):
            n = counts[a:a + len(r.centres)]
            new = np.where(n[:, None] > 0, sums[a:a + len(n)] / np.maximum(n, 1)[:, None], r.centres)
            moved = ((new - r.centres) ** 2).sum(1).max()
            r.centres, r.cost = new, float(cost)
            if moved > tol * tol:
                moving.append(r)
        live, done = moving, done + 1
    return list(runs)


def _pack(centres: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different rows of all lists, and the row numbers of each list."""
    at: dict[bytes, int] = {}
    places = [np.array([at.setdefault(row.tobytes(), len(at)) for row in one], dtype=np.int64) for one in centres]
    return np.stack([np.frombuffer(row) for row in at]), places


def _costs(x: np.ndarray, centres: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
    """(lists, rows): squared distance of each row to the nearest of each list's centres."""
    own = (x * x).sum(1)
    d = (-2.0 * centres) @ x.T
    d += (centres * centres).sum(1)[:, None]
    near = np.stack([d[p].min(0) for p in places]) + own
    return np.where(near > 1e-12 * own, near, 0.0)  # a centre's own row: no rest of the rounding


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(centres, rows): squared distances, rounded as Spark's are for sparse rows (one product after the other)."""
    dot = np.zeros((len(centres), len(x)))
    squares = [np.zeros(len(centres)), np.zeros(len(x))]
    for j in range(x.shape[1]):
        a, b = centres[:, j], x[:, j]
        dot += a[:, None] * b
        squares[0] += a * a
        squares[1] += b * b
    a, b = (np.sqrt(q) for q in squares)
    return (a * a)[:, None] + b * b - 2.0 * dot


def _first_centres(df: DataFrame, blocks: RDD, width: int, seeds: list[int], parallelism: int) -> dict[int, np.ndarray]:
    """The row that Spark's ``KMeans`` takes first for each seed of its sampling (one row of ``takeSample``)."""
    rows = df.select(F.monotonically_increasing_id().alias("at"))._jdf.javaRDD()
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(seeds)))) as pool:
        found = dict(zip(seeds, pool.map(lambda s: rows.takeSample(False, 1, s).get(0).getLong(0), seeds)))
    wanted: dict[int, set] = {}
    for at in found.values():
        wanted.setdefault(at >> 33, set()).add(at & ((1 << 33) - 1))

    def fetch(index, part):
        places, before = sorted(wanted.get(index, ())), 0
        for block in part if places else ():
            n = len(block) // (8 * width)
            yield from (((index << 33) + p, block[8 * width * (p - before):8 * width * (p - before + 1)]) for p in places if before <= p < before + n)
            before += n
    got = dict(blocks.mapPartitionsWithIndex(fetch).collect())
    return {s: np.frombuffer(got[at]) for s, at in found.items()}


def starting_centres(df: DataFrame, blocks: RDD, width: int, runs: list[tuple[int, int]], parallelism: int = 4) -> list[np.ndarray]:
    """The centres that Spark's ``KMeans`` starts each (k, seed) from, for all runs in the same passes.

    As there (k-means||): a first row, then two steps that take each row with a chance of 2 k times its share of the cost, and
    k-means++ over what was taken, weighted by the rows nearest to it. The draws are Spark's (``operators.draws``), so they
    depend on the seed, the partition and the row's place in it; runs of one seed share them. Equally near centres are told
    apart by Spark's rounding of sparse rows."""
    jvm = df.sparkSession._jvm
    sampling = {seed: jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt() for seed in {seed for _, seed in runs}}
    streams = sorted(set(sampling.values()))
    first = _first_centres(df, blocks, width, streams, parallelism)
    centres = [[first[sampling[seed]]] for _, seed in runs]
    for step in range(STEPS):
        # costs are of the centres so far: what a step adds can only lower them
        rows, places = _pack(centres)
        lists: dict[bytes, int] = {}
        own = [lists.setdefault(p.tobytes(), len(lists)) for p in places]  # runs with the same centres share their costs
        places = [np.frombuffer(key, dtype=np.int64) for key in lists]
        sent = blocks.context.broadcast((rows, places))

        def total(part, sent=sent):
            rows, places = sent.value
            yield sum((_costs(x, rows, places).sum(1) for x in _chunks(part, width, len(rows))), np.zeros(len(places)))
        sums = blocks.mapPartitions(total).treeReduce(lambda a, b: a + b)
        asked = [(own[r], k, float(sums[own[r]]), streams.index(sampling[seed])) for r, (k, seed) in enumerate(runs)]

        def chosen(index, part, sent=sent, step=step, asked=asked):
            rows, places = sent.value
            draws = Draws([s ^ (step << 16) ^ index for s in streams])
            for x in _chunks(part, width, max(len(rows), len(asked))):
                cost, chance = _costs(x, rows, places), draws.take(len(x))
                hits = np.stack([chance[s] < 2.0 * cost[o] * k / total if total > 0 else np.zeros(len(x), bool) for o, k, total, s in asked])
                for i in np.flatnonzero(hits.any(0)):
                    yield np.flatnonzero(hits[:, i]).tolist(), x[i].tobytes()
        taken = blocks.mapPartitionsWithIndex(chosen).collect()  # some 2 k rows a run
        sent.unpersist()
        for who, row in taken:
            row = np.frombuffer(row)
            for r in who:
                centres[r].append(row)
    different = [list({row.tobytes(): row for row in one}.values()) for one in centres]
    rows, places = _pack(different)
    sent = blocks.context.broadcast((rows, places))

    def nearest_rows(part):
        rows, places = sent.value
        counts = [np.zeros(len(p), dtype=np.int64) for p in places]
        norms, twice = (rows * rows).sum(1)[:, None], -2.0 * rows
        for x in _chunks(part, width, len(rows)):
            own = (x * x).sum(1)
            d = twice @ x.T
            d += norms
            margin = TIED * (own + norms.max())
            for n, p in zip(counts, places):
                to = d[p]
                best, at = to.min(0), to.argmin(0)
                close = to <= best + margin
                if np.count_nonzero(close) > len(x):
                    tied = np.flatnonzero(close.sum(0) > 1)
                    at[tied] = _distances(x[tied], rows[p]).argmin(0)
                n += np.bincount(at, minlength=len(p))
        yield np.concatenate(counts)
    counts = np.split(blocks.mapPartitions(nearest_rows).treeReduce(lambda a, b: a + b), np.cumsum([len(p) for p in places])[:-1])
    sent.unpersist()
    return _plus_plus(df.sparkSession, [k for k, _ in runs], rows, places, counts)


def _plus_plus(spark, ks: list[int], rows: np.ndarray, places: list[np.ndarray], weights: list[np.ndarray]) -> list[np.ndarray]:
    """For each run k centres of its few weighted rows, by the k-means++ of Spark's ``KMeans``; all of them, if there are no more."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kind, wrap = jvm.org.apache.spark.mllib.clustering.VectorWithNorm, jvm.java.nio.ByteBuffer

    def sent(values):
        out = gateway.new_array(jvm.double, len(values))
        wrap.wrap(values.astype(">f8").tobytes()).asDoubleBuffer().get(out)
        return out

    def read(vector):
        buffer = wrap.allocate(8 * rows.shape[1])
        buffer.asDoubleBuffer().put(vector.toArray())
        return np.frombuffer(buffer.array(), ">f8").astype("float64")
    vectors: dict[int, object] = {}
    out = []
    for k, place, n in zip(ks, places, weights):
        if len(place) <= k:
            out.append(rows[place])
            continue
        points = gateway.new_array(kind, len(place))
        for i, at in enumerate(place.tolist()):
            if at not in vectors:
                vectors[at] = kind(sent(rows[at]))
            points[i] = vectors[at]
        found = jvm.org.apache.spark.mllib.clustering.LocalKMeans.kMeansPlusPlus(0, points, sent(n.astype(float)), k, 30)
        out.append(np.stack([read(c.vector()) for c in found]))
    return out


def fit_runs(df: DataFrame, runs: list[tuple[int, int]], features: str = "features", max_iter: int = 300, tol: float = 1e-4,
             parallelism: int = 4) -> list[KMeansRun]:
    """One fitted run for each (k, seed). ``df`` is read once for the blocks and its rows are counted, so it should be persisted."""
    width = len(df.select(features).first()[0])
    blocks = row_blocks(df, features, width).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        begun = [KMeansRun(k, seed, c) for (k, seed), c in zip(runs, starting_centres(df, blocks, width, runs, parallelism))]
        return lloyd(blocks, begun, max_iter, tol)
    finally:
        blocks.unpersist()
