"""Benchmark decontamination: a prefix-filtered set join, in DataFrame functions only.

An item's window (ten consecutive words; all words of a shorter item) is a set of short word
shingles. A window occurs in a document only if all its shingles do, so at containment one the
necessary prefix is a single shingle: the rarest in the documents. Documents' shingles meet
only these prefix shingles; a match gives the one place where the window could start, which
length and positional bounds check before the words themselves are compared.

Shingles have ``SHINGLE`` words (windows with fewer words: as many as the window). They join by
64-bit hash, which only proposes candidates: the comparison is on the words.

Texts are cut into words once: that scan keeps the shingles that some window has, and rarity counts and
prefix matches are taken from what it wrote. The documents with a prefix in place are read again for
the comparison.

Sides. The windows come from the benchmark and are counted first, with their items: up to ``BROADCAST`` together
they are broadcast, and documents are neither shuffled nor sorted; beyond it both sides shuffle by
the shingle. Hot shingles (a phrase that most documents share) are prefixes only of windows that have
nothing rarer.

Defined results: NULL and empty texts have no words and are not contaminated; items without words
have no windows; items of equal windows all count; a window that occurs twice counts once per
item; repeated rows are judged row by row; rows that share a doc_id but not a text are judged
apart; an empty benchmark contaminates nothing; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sevscope.session import write_stage

from .common import pick

#: A word is a run of ASCII digits and letters and of all non-ASCII characters.
BENCH_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WINDOW = 10
SHINGLE = 3
#: Windows and their items (under 1 KB or so each), or keys of candidates, that may be broadcast.
BROADCAST = 100_000


def bench_words(text: Column) -> Column:
    """The words of a text with A-Z lower-cased. ``lower`` does it for texts of ASCII alone."""
    t = F.coalesce(text, F.lit(""))
    ascii_only = F.length(t) == F.octet_length(t)
    return F.regexp_extract_all(F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, UPPER, LOWER)),
                                F.lit(BENCH_WORD), F.lit(0))


def hashes(words: Column, size: int) -> Column:
    """Hash of the shingle of ``size`` words from each word on. Shorter ones at the end differ from
    all whole shingles (but for chance, and the words decide)."""
    return F.transform(words, lambda w, i: F.xxhash64(F.lit(size), w, *(F.get(words, i + k) for k in range(1, size))))


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: (window, items, size, shingle); ``items`` have it,
    ``shingle`` is the number of words of its shingles."""
    w = pick(items, "item_id", "text").select("item_id", bench_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return (w.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("window"))
            .groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
            .select("window", "items", F.size("window").alias("size"), F.least(F.size("window"), F.lit(SHINGLE)).alias("shingle")))


def _small(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def shingles_of(wins: DataFrame, sizes: list[int]) -> DataFrame:
    """(window, items, size, at, h): every window's shingles and their places in it."""
    parts = [wins.where(F.col("shingle") == n).select("window", "items", "size", F.posexplode(F.slice(
        hashes(F.col("window"), n), F.lit(1), F.col("size") - n + 1)).alias("at", "h")) for n in sizes]
    own = parts[0]
    for p in parts[1:]:
        own = own.unionByName(p)
    return own


def scan(docs: DataFrame, own: DataFrame, sizes: list[int], small: bool) -> tuple[DataFrame, DataFrame]:
    """One scan of the texts: (doc_id, text_hash, n_words) of every row, and (doc_id, text_hash, n_words, place, h)
    of the shingles that some window has. Written. Where the shingles of the windows are broadcast, a mark that
    every row carries passes the same join, so both come out of it; a shuffle join would get all marks in one task,
    so there the rows are read on their own."""
    d = (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), bench_words(F.col("text")).alias("words"))
         .withColumn("n_words", F.size("words")))
    key = ["doc_id", "text_hash", "n_words"]
    at = [F.transform(hashes(F.col("words"), n), lambda h, i: F.struct(i.alias("place"), h.alias("h"))) for n in sizes]
    wanted = own.select("h").distinct()
    if not small:
        rows = write_stage(d.select(*key), "words")
        return rows, write_stage(d.select(*key, F.inline(F.concat(*at))).join(wanted, "h", "left_semi"), "shingles")
    mark = F.array(F.struct(F.lit(-1).alias("place"), F.lit(0).cast("long").alias("h")))
    wanted = wanted.union(docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("h"))).distinct()
    met = write_stage(d.select(*key, F.inline(F.concat(mark, *at))).join(F.broadcast(wanted), "h", "left_semi"), "shingles")
    return met.where("place < 0").select(*key), met.where("place >= 0")


def prefixes(met: DataFrame, own: DataFrame) -> DataFrame:
    """Windows with their rarest shingle: (window, items, size, at, h). Counts come from all
    documents; a window with a shingle that no document has cannot occur and goes."""
    counts = met.groupBy("h").count()
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "h", "at")).alias("rarest")
    return (own.join(counts, "h", "left").groupBy("window").agg(F.first("items").alias("items"), F.first("size").alias("size"), rarest)
            .where("rarest.n > 0").select("window", "items", "size", "rarest.at", "rarest.h"))


def occurrences(docs: DataFrame, met: DataFrame, pre: DataFrame, small: bool, broadcast_rows: int) -> DataFrame:
    """Where windows occur: (doc_id, text_hash, start, end, items). Only documents with a prefix in place are read for their words."""
    start = F.col("place") - F.col("at")
    near = (met.join(_small(pre, small), "h").withColumn("start", start).withColumn("end", start + F.col("size"))
            .where((F.col("start") >= 0) & (F.col("end") <= F.col("n_words"))))
    near = write_stage(near.select("doc_id", "text_hash", "start", "end", "size", "window", "items"), "candidates")
    ids = near.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")).distinct()
    few = ids.count() <= broadcast_rows
    text = docs.select("doc_id", "text").join(_small(ids, few), F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.xxhash64("text") == F.col("of_hash")))
    of = text.dropDuplicates(["of_id", "of_hash"]).select("of_id", "of_hash", bench_words(F.col("text")).alias("words"))
    met = near.join(of, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")))
    return (met.where(F.slice("words", F.col("start") + 1, F.col("size")) == F.col("window"))
            .select("doc_id", "text_hash", "start", "end", "items"))


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_rows: int = BROADCAST) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, n_words) of every row, and the documents that have a window: (doc_id, text_hash, n_hit, item_ids);
    ``item_ids`` are strings in order."""
    wins = write_stage(windows(items, window), "windows")
    n_wins, n_items = wins.agg(F.count("*"), F.coalesce(F.sum(F.size("items")), F.lit(0))).first()
    small = n_wins + n_items <= broadcast_rows
    sizes = [r["shingle"] for r in wins.select("shingle").distinct().collect()]  # SHINGLE values at most
    docs = pick(docs, "doc_id", "text")
    if not sizes:
        none = "doc_id {}, text_hash long, n_hit long, item_ids array<string>".format(docs.schema["doc_id"].dataType.simpleString())
        rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(bench_words(F.col("text"))).alias("n_words"))
        return rows, docs.sparkSession.createDataFrame([], none)
    own = shingles_of(wins, sizes)
    rows, met = scan(docs, own, sizes, small)
    found = occurrences(docs, met, write_stage(prefixes(met, own), "prefixes"), small, broadcast_rows)
    per_doc = found.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("ids"))
    hit = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                      lambda a, x: F.struct((a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["end"]), F.lit(0))).alias("n"),
                                            F.greatest(x["end"], a["end"]).alias("end")), lambda a: a["n"])
    return rows, per_doc.select("doc_id", "text_hash", hit.cast("long").alias("n_hit"),
                                F.sort_array(F.transform("ids", lambda i: i.cast("string"))).alias("item_ids"))


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_rows: int = BROADCAST) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    base, hits = find(docs, items, window, broadcast_rows)
    hits = hits.withColumnsRenamed({"doc_id": "of_id", "text_hash": "of_hash"})
    base = base.withColumn("n_words", F.col("n_words").cast("long"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return base.join(hits, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_rows: int = BROADCAST) -> DataFrame:
    """``docs`` without the contaminated documents."""
    hits = find(docs, items, window, broadcast_rows)[1].select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("__doc"), docs["doc_id"].alias("__of"),
                       F.xxhash64(docs["text"]).alias("__text"))
    return rows.join(hits, F.col("__of").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash")), "left_anti").select("__doc.*")
