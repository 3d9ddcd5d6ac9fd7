"""Mixing sources to target weights.

Words are summed per source; the sources' weights share all words, a source stops at ``CAP``
times its own words and the excess goes to the others by weight; target / own words is the
source's rate. A document is taken floor(rate) times and once more if its draw, a hash of its
id in [0, 1), lies below the fraction.

The draw's threshold. The words of the documents drawn stray from the fraction's share, by
several per cent for sources of a thousand documents and far more for small ones. So the draws
of all documents are summed in ``SLICES`` equal slices per source, and the threshold is the
slice edge whose summed words come nearest to that share: the fraction, corrected by what its
own draw would miss.

Only sums per source and slice shuffle (combined before); no row moves to be taken. The table of
sources joins by broadcast if it has ``BROADCAST`` rows at most, else by a shuffle, where
adaptive execution splits a hot source.

Defined results: a NULL text has no words; NULL is a source of its own, the last; a source
without words has target 0 and its documents are not taken; a row without doc_id draws by its
text; repeated rows draw alike, each row by itself; an empty table gives an empty result; other
columns pass through ``mix`` and are not read otherwise.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sevscope.session import write_stage

from .common import n_words

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix-1"
#: A draw has 12 bits.
SLICES = 4096
BROADCAST = 100_000


def _slice(doc_id, text, seed: str):
    """Number of the slice in which the row's draw lies."""
    of = F.coalesce(F.concat(F.lit(f"{seed}:id:"), doc_id.cast("string")), F.concat(F.lit(f"{seed}:text:"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(of), 1, 3), 16, 10).cast("int")


def measure(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, slice) of every row, as a written table."""
    return write_stage(docs.select(docs["doc_id"], docs["source"], n_words(docs["text"]).alias("size"),
                                   _slice(docs["doc_id"], docs["text"], seed).alias("slice")), "mix-sizes")


def rates(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per source: (source, source_size, target, whole, below): documents are taken
    ``whole`` times, and once more if their slice is under ``below``. The windows without a
    partition run over one row per source."""
    sums = write_stage(sizes.groupBy("source", "slice").agg(F.sum("size").alias("words")), "mix-slices")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = (sums.groupBy("source").agg(F.sum("words").alias("source_size"))
         .withColumn("weight", F.get(F.array(*(F.lit(w) for w in weights)), (F.row_number().over(by_name) - 1) % len(weights)))
         .withColumn("most", F.lit(cap) * F.col("source_size")))
    # sources in the order in which they reach their cap as the level per weight rises
    ahead = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    s = (s.withColumn("left", (F.sum("source_size").over(every) - F.sum("most").over(ahead) + F.col("most")).cast("double"))
         .withColumn("heavy", F.sum("weight").over(every) - F.sum("weight").over(ahead) + F.col("weight"))
         .withColumn("level", F.col("left") / F.col("heavy"))
         .withColumn("capped", F.col("level") > F.col("most") / F.col("weight"))
         .withColumn("level", F.max(F.when(~F.col("capped"), F.col("level"))).over(every)))
    s = s.select("source", "source_size", F.when(F.col("capped"), F.col("most").cast("double")).otherwise(F.col("level") * F.col("weight")).alias("target"))
    s = s.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    s = s.withColumn("more", F.col("target") - F.col("whole") * F.col("source_size"))
    # edge k has the slices under k below it; edge 0 none
    up_to = Window.partitionBy("source").orderBy("slice")
    edges = (sums.select("source", (F.col("slice") + 1).alias("edge"), F.sum("words").over(up_to).alias("drawn"))
             .unionByName(s.select("source", F.lit(0).alias("edge"), F.lit(0).cast("long").alias("drawn"))))
    e = edges.select(F.col("source").alias("of"), "edge", "drawn")
    best = F.min(F.struct(F.abs(F.col("drawn") - F.col("more")).alias("off"), "edge")).alias("best")
    return (s.join(e, F.col("source").eqNullSafe(F.col("of"))).groupBy("source", "source_size", "target", "whole").agg(best)
            .select("source", "source_size", "target", "whole", F.col("best.edge").alias("below")))


def _rated(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with source and slice) beside their source's row of ``plan``, with ``copies``."""
    plan = write_stage(plan, "mix-rates")
    small = plan.count() <= BROADCAST
    plan = plan.withColumnRenamed("source", "__of")
    copies = F.col("whole") + F.when(F.col("slice") < F.col("below"), 1).otherwise(0)
    return rows.join(F.broadcast(plan) if small else plan, rows["source"].eqNullSafe(F.col("__of"))).withColumn("copies", copies)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source, copies."""
    sizes = measure(docs)
    return _rated(sizes, rates(sizes)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "source", "copies")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every document as many times as it is taken."""
    plan = rates(measure(docs))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("__doc"), docs["source"].alias("source"),
                       _slice(docs["doc_id"], docs["text"], SEED).alias("slice"))
    return _rated(rows, plan).where("copies > 0").select("__doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__doc.*")
