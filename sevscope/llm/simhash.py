"""SimHash near-duplicates by multi-index hashing.

``fingerprints`` gives each text its 64-bit SimHash over word shingles; ``links`` finds
pairs of distinct fingerprints at most three bits apart; ``components`` closes them.

Search. A fingerprint has two halves of 32 bits. Two fingerprints that differ in three bits
or fewer agree in one half up to one bit, so every fingerprint probes, for each half, the
table of that half at its own value and at every value with one more bit set (of two values
one bit apart, one has the bit and is found by the other). Matches are verified on all 64 bits.

Hot buckets. A table bucket of more than ``BUCKET`` fingerprints is not multiplied out. Its
members share the half and are distinct in the other one, so they are spread over the points
of the small balls around their other half: a member goes to the points within two bits
(probing members from one bit away: within one bit). Whoever meets a table member within one
bit at a point lies within three bits of it, and any two members that should be linked meet so
at some point; linking each to the smallest such member keeps the components exact with
rows in proportion to the members. A point holds 1,585 members at most.

Exact copies collapse to one fingerprint first, so a group of copies of any size is one row.

Defined results: NULL and empty texts have no words, get fingerprint zero and are linked like
any other; texts of fewer words than a shingle count as one shingle; repeated rows share a
fingerprint and stay rows of their own; rows without ``doc_id`` get their component's smallest
``doc_id`` (NULL if none has one); an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sevscope.session import write_stage

from .common import pick

SHINGLE = 3
DISTANCE = 3
SEED = 42
BUCKET = 128
#: Shingles hashed at a time, which bounds the memory of a long text.
BLOCK = 1 << 16

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
HALVES = (0, 32)


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text: bit i is set if over half the shingle hashes set it."""
    ws = (text or b"").translate(LOWER).split()  # bytes split at exactly \x20 and \x09-\x0D
    if not ws:
        return 0
    n = max(1, len(ws) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(ws[i:i + shingle]), SEED)
                         for i in range(at, min(n, at + BLOCK))), "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): ``fp`` is the fingerprint as a signed 64-bit number;
    ``text_hash`` tells rows without doc_id apart."""

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([simhash(t, shingle) for t in s], dtype="int64")

    return pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("text_hash"),
                                               fp(F.col("text").cast("binary")).alias("fp"))


def _half(at: int):
    return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit(0xFFFFFFFF))


def _per_half(fps: DataFrame, values) -> DataFrame:
    """A row for each half and each of ``values(half value)``."""
    rows = [F.struct(F.lit(k).alias("half"), values(_half(at)).alias("values")) for k, at in enumerate(HALVES)]
    return (fps.select("fp", F.explode(F.array(*rows)).alias("x"))
            .select("fp", "x.half", F.explode("x.values").alias("value")))


def _balls(bits: int) -> list[int]:
    """Masks of ``bits`` of 32 bits."""
    if bits == 0:
        return [0]
    return sorted({m | 1 << b for m in _balls(bits - 1) for b in range(32) if not m >> b & 1})


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints of ``fps`` (column fp, no repeats) that give
    the components of "at most three bits apart"; every pair that shares a bucket of up to
    ``bucket`` fingerprints is among them."""
    near = F.array(*(F.lit(1 << b) for b in range(32)))
    table = _per_half(fps, lambda v: F.array(v))
    probes = _per_half(fps, lambda v: F.concat(F.array(v), F.filter(
        F.transform(near, lambda m: v.bitwiseOR(m)), lambda x: x != v)))
    hot = table.groupBy("half", "value").count().where(F.col("count") > bucket).select("half", "value")
    key = ["half", "value"]

    cold = table.join(hot, key, "left_anti").withColumnRenamed("fp", "b")
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("b")))
    pairs = (probes.join(cold, key).where((F.col("fp") != F.col("b")) & (apart <= DISTANCE))
             .select(F.least("fp", "b").alias("a"), F.greatest("fp", "b").alias("b")))

    own = F.when(F.col("half") == 0, _half(HALVES[0])).otherwise(_half(HALVES[1]))
    other = F.when(F.col("half") == 0, _half(HALVES[1])).otherwise(_half(HALVES[0]))
    r0, r1, r2 = (F.array(*(F.lit(m) for m in _balls(n))) for n in range(3))
    members = probes.join(hot, key, "left_semi").withColumn("at_home", own == F.col("value"))
    reach = F.when(F.col("at_home"), F.concat(r0, r1, r2)).otherwise(F.concat(r0, r1))
    points = (members.withColumn("rest", other)
              .select("half", "value", "fp", "at_home", "rest", F.explode(reach).alias("mask"))
              .withColumn("point", F.col("rest").bitwiseXOR(F.col("mask"))))
    close = F.col("at_home") & (F.bit_count("mask") <= 1)
    hub = F.min(F.when(close, F.col("fp"))).over(Window.partitionBy("half", "value", "point"))
    stars = (points.withColumn("hub", hub).where(F.col("hub").isNotNull() & (F.col("hub") != F.col("fp")))
             .select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a < b); root is the smallest node reachable.

    Alternates two steps that keep the components and shorten the paths: every node hands its
    larger neighbours to its smallest neighbour, then every node hands its smaller neighbours
    to the smallest of them. Ends when the edges stay the same; each round is a written table.
    """
    edges = write_stage(edges.select("a", "b"), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where(F.col("b") > F.col("a")).join(low, "a").where(F.col("b") != F.col("m"))
                 .select(F.col("m").alias("a"), "b").distinct())
        # a < b: towards the smaller ones
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(
            F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")),
                              F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        edges = write_stage(small.where("a < b").distinct(), "links")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if state == seen:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        seen = state


def classes(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``prints`` (doc_id, text_hash, fp; a written table) with ``keeper``: the smallest row of the
    component as a struct (no_id, doc_id, text_hash), rows with a doc_id first."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    # one row per distinct fingerprint, combined before the shuffle
    fps = write_stage(prints.groupBy("fp").agg(F.min(row).alias("first")), "fingerprints")
    roots = components(links(fps.select("fp"), bucket))
    rooted = (fps.join(roots, fps["fp"] == roots["node"], "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    keepers = rooted.groupBy("root").agg(F.min("first").alias("keeper"))
    by_fp = rooted.join(keepers, "root").select("fp", "keeper")
    return prints.join(by_fp, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = write_stage(fingerprints(docs, shingle), "prints")
    return classes(prints, bucket).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("keeper.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one document of each component: the row of the smallest doc_id, or one row of a component without any doc_id; of rows alike in doc_id and
    text the one whose other columns come first in order."""
    prints = write_stage(fingerprints(docs, shingle), "prints")
    # neither column of the key is NULL, so join and aggregate share one exchange of the texts
    key = ["__id", "__hash"]
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    keepers = classes(prints, bucket).select(
        name(F.col("keeper.doc_id")).alias("__id"), F.col("keeper.text_hash").alias("__hash")).distinct()
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("__doc"), name(docs["doc_id"]).alias("__id"),
                       F.xxhash64(docs["text"]).alias("__hash"))
    # maps and variants have no order of their own
    def sortable(field):
        value = F.col("__doc").getField(field.name)
        return F.to_json(F.struct(value)) if re.search("map<|variant", field.dataType.simpleString()) else value

    order = F.struct(F.lit(0), *(sortable(f) for f in docs.schema if f.name not in ("doc_id", "text")))
    return rows.join(keepers, key, "left_semi").groupBy(*key).agg(F.min_by("__doc", order).alias("__doc")).select("__doc.*")
