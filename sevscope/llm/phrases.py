"""Phrase collocations per language, counted in quotient filters.

Words get dense ids (those of fewer than ``least`` occurrences none: no phrase with one of them can
be a candidate, nor can a part of a candidate have one), and texts become id sequences, written once.
Then each length of phrase, 2 to ``LONGEST``, takes one pass:

* every task counts the n-grams of its sequences in counting quotient filters (``quotient``) of bounded
  size and sends their slices, so equal n-grams of a task move once, in a few bytes;
* one group per slice merges the filters into one and keeps the entries of ``least`` or more. The
  permutation spreads n-grams evenly, and the number of slices grows with the words counted, so a slice
  is of bounded size whatever the corpus repeats;
* the quotients that kept entries occupy form a map of at most 2^26 flags (8 MB). The next pass counts an
  n-gram only if both its shorter n-grams are on the map. It spares work and decides nothing: what passes
  by chance is counted exactly and goes if it is too rare.

Scores, containment and ranks are joins and aggregates of the kept n-grams.

Words are encoded with a broadcast table of up to ``BROADCAST_WORDS`` frequent words, beyond that by a
shuffle join of the tokens.

Defined results: NULL and empty texts have no words; a NULL lang is ``und``; repeated rows count each;
an empty table, or one without candidates, gives no rows; ties are ordered by the phrase; texts are
counted whole, in pieces of bounded size; other columns are not read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sevscope.session import write_stage

from .common import pick
from .quotient import Filter, Layout

#: What ends a piece, and a word.
STOP = ".,;:!?\\x0A-\\x0D"
PHRASE_WORD = f"[^\\x20\\x09{STOP}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LONGEST = 4
LEAST = 30
TOP = 2000
#: Frequent words (of 400,000 about 40 MB in a task) that may be broadcast.
BROADCAST_WORDS = 400_000
#: Characters that are cut into words at once, ids that are counted at once, entries a task holds, words a slice is made for.
CUT, CHUNK, HELD, SLICE = 1_000_000, 1_000_000, 2_000_000, 4_000_000

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def _lang(docs: DataFrame) -> Column:
    return F.coalesce(docs["lang"].cast("string"), F.lit("und"))


def _lowered(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, word, f, mark): the words of ``least`` or more, and a row without a word for each lang's others.
    ``mark`` numbers the rows, with gaps."""
    words = (docs.select(_lang(docs).alias("lang"), F.explode(F.regexp_extract_all(_lowered(docs["text"]), F.lit(PHRASE_WORD), F.lit(0))).alias("word"))
             .groupBy("lang", "word").agg(F.count("*").alias("f")))
    folded = words.groupBy("lang", F.when(F.col("f") >= least, F.col("word")).alias("word")).agg(F.sum("f").alias("f"))
    return write_stage(folded.withColumn("mark", F.monotonically_increasing_id()), "phrase-words")


def vocabulary(counts: DataFrame) -> DataFrame:
    """(lang, word, f, id) of the frequent words; ids are 1, 2, ... without gaps."""
    part = F.shiftright("mark", 33)
    words = counts.where(F.col("word").isNotNull()).withColumn("part", part)
    # one row per task of the count
    before = words.groupBy("part").agg(F.count("*").alias("rows")).select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("mark"))
    return words.join(F.broadcast(before), "part").select("lang", "word", "f", (F.col("before") + within).alias("id"))


def _tokens(text: str) -> Iterator[list[str]]:
    """Words and ends of pieces, a bounded stretch of the text at a time."""
    find, at = re.compile(f"{PHRASE_WORD}|[{STOP}]").findall, 0
    gap = re.compile(f"[\\x20\\x09{STOP}]")
    while at < len(text):
        cut = gap.search(text, at + CUT)
        end = cut.start() if cut else len(text)
        yield find(text, at, end) if (at, end) != (0, len(text)) else find(text)
        at = end


def encode(docs: DataFrame, words: DataFrame, small: bool) -> DataFrame:
    """(ids): the word ids of each text in order; 0 for rare words, ends of pieces and the end."""
    texts = docs.select(_lang(docs).alias("lang"), docs["text"].alias("text"))
    if small:
        table: dict[str, dict[str, int]] = {}
        for lang, word, number in words.select("lang", "word", "id").toPandas().itertuples(index=False):
            table.setdefault(lang, {})[word] = number
        sent = docs.sparkSession.sparkContext.broadcast(table)

        def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in it:
                flat, ends = [], [0]
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    get, n = sent.value.get(lang, {}).get, ends[-1]
                    for some in _tokens((text or "").encode().translate(_LOWER).decode()):
                        flat.append(np.fromiter((get(x, 0) for x in some), np.int64, len(some)))
                        n += len(some)
                    flat.append(np.zeros(1, np.int64))
                    ends.append(n + 1)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat) if flat else [], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids], ["ids"])

        return texts.mapInArrow(batches, "ids array<long>")
    # a written mark names the rows: it must be the same whenever a task is run again
    rows = write_stage(texts.withColumn("row", F.monotonically_increasing_id()), "phrase-texts")
    tokens = rows.select("row", "lang", F.posexplode(F.regexp_extract_all(_lowered(F.col("text")), F.lit(f"{PHRASE_WORD}|[{STOP}]"), F.lit(0))).alias("at", "word"))
    met = tokens.join(words.select("lang", "word", "id"), ["lang", "word"], "left")
    ids = F.transform(F.sort_array(F.collect_list(F.struct("at", F.coalesce("id", F.lit(0)).alias("id")))), lambda x: x["id"])
    return met.groupBy("row").agg(F.concat(ids, F.array(F.lit(0).cast("long"))).alias("ids")).select("ids")


def _grams(ids: np.ndarray, size: int, shorter: tuple[Layout, np.ndarray] | None) -> list[np.ndarray]:
    """One array per word of the n-grams of ``size`` words that may be frequent."""
    if len(ids) < size:
        return [np.empty(0, np.int64)] * size
    if shorter is None:
        good = ids > 0
    else:
        lay, flags = shorter
        of = [ids[i:len(ids) - size + 2 + i] for i in range(size - 1)]
        good = np.all([x > 0 for x in of], axis=0)
        at = np.flatnonzero(good)
        q = lay.quotients(*lay.pack([x[at] for x in of])).astype(np.int64)
        good[at] = (flags[q >> 3] >> (7 - (q & 7)).astype(np.uint8)) & 1 == 1
    at = np.flatnonzero(good[:-1] & good[1:])
    return [ids[at + i] for i in range(size)]


def count(encoded: DataFrame, lay: Layout, slice_bits: int, least: int, shorter: tuple[Layout, bytes] | None) -> DataFrame:
    """(slice, entries, occupied): each slice's merged filter of the n-grams with ``least`` or more
    occurrences, and the flags of its quotients. Written."""
    sc = encoded.sparkSession.sparkContext
    sent = sc.broadcast(shorter)
    schema = pa.schema([("slice", pa.int64()), ("entries", pa.binary())])

    def rows(parts: list[Filter]) -> Iterator[pa.RecordBatch]:
        for number, part in Filter.merge(lay, parts).slices(slice_bits):
            yield pa.RecordBatch.from_pydict({"slice": [number], "entries": [part.to_bytes()]}, schema)

    def fill(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value and (sent.value[0], np.frombuffer(sent.value[1], np.uint8))
        parts: list[Filter] = []
        for batch in it:
            ids = batch.column(0).flatten().to_numpy()
            for at in range(0, len(ids), CHUNK):  # n-grams that begin in the chunk
                parts.append(Filter.of(lay, _grams(ids[at:at + CHUNK + lay.size - 1], lay.size, known)))
                if sum(map(len, parts)) > HELD:
                    parts = [Filter.merge(lay, parts)]
                    if len(parts[0]) > HELD // 2:
                        yield from rows(parts)
                        parts = []
        if parts:
            yield from rows(parts)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        whole = Filter.merge(lay, [Filter.from_bytes(lay, x.as_py()) for x in table.column("entries")])
        kept, number = whole.where(whole.n >= least), key[0].as_py()
        return pa.table({"slice": pa.array([number], pa.int64()), "entries": pa.array([kept.to_bytes()], pa.binary()),
                         "occupied": pa.array([kept.occupied(slice_bits, number)], pa.binary())})

    filled = encoded.mapInArrow(fill, "slice long, entries binary")
    return write_stage(filled.groupBy("slice").applyInArrow(merge, "slice long, entries binary, occupied binary"), f"phrase-grams{lay.size}")


def occupancy(slices: DataFrame, lay: Layout, slice_bits: int) -> bytes:
    """The flags of all quotients: 2^quotient bits, however many n-grams there are."""
    width = 1 << (lay.quotient - slice_bits)
    flags = np.zeros(1 << lay.quotient, bool)
    for number, some in slices.select("slice", "occupied").toLocalIterator():
        flags[number * width:(number + 1) * width] = np.unpackbits(np.frombuffer(some, np.uint8), count=width)
    return np.packbits(flags).tobytes()


def entries(slices: DataFrame, lay: Layout) -> DataFrame:
    """(ids, f) of the filters' entries."""
    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for data in batch.column(0):
                f = Filter.from_bytes(lay, data.as_py())
                for at in range(0, len(f), 100_000):
                    ids = lay.unpack(f.a[at:at + 100_000], f.b[at:at + 100_000])
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * lay.size), pa.array(ids.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([lists, pa.array(f.n[at:at + 100_000])], ["ids", "f"])

    return slices.select("entries").mapInArrow(read, "ids array<long>, f long")


def scored(grams: DataFrame) -> DataFrame:
    """(ids, a, score, l, r) of the phrases of two words or more, by their lowest cut."""
    size = F.size("ids")
    cuts = (grams.where(size > 1).select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
            .select("ids", "a", "k", F.inline(F.array(F.struct(F.lit(True).alias("first"), F.slice("ids", F.lit(1), F.col("k")).alias("part")),
                                                      F.struct(F.lit(False).alias("first"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("part"))))))
    met = cuts.join(grams.select(F.col("ids").alias("part"), "f"), "part")
    side = [F.max(F.when((F.col("k") == k) & (F.col("first") == first), F.col("f"))).alias(f"{'l' if first else 'r'}{k}")
            for k in range(1, LONGEST) for first in (True, False)]
    wide = met.groupBy("ids", "a").agg(*side)
    # decimals: the product may pass 64 bits
    value = "(cast(2000000 as decimal(10)) * cast(a as decimal(19))) div (cast(l{0} as decimal(19)) + cast(r{0} as decimal(19)))"
    cut = [F.when(F.col(f"l{k}").isNotNull(), F.struct(F.expr(value.format(k)).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
           for k in range(1, LONGEST)]
    return wide.select("ids", "a", F.array_min(F.array(*cut)).alias("cut")).select("ids", "a", "cut.score", "cut.l", "cut.r")


def independent(candidates: DataFrame) -> DataFrame:
    """Candidates that no longer one takes up: 100 f(longer) < 80 a for all that hold their words."""
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("ids") - n + 1), lambda i: F.slice("ids", i, n))))
    longer = (candidates.where(F.size("ids") > 2).select(F.explode(inner).alias("ids"), F.col("a").alias("longer"))
              .groupBy("ids").agg(F.max("longer").alias("longer")))
    taken = F.expr("cast(longer as decimal(19)) * 100 >= cast(a as decimal(19)) * 80")
    return candidates.join(longer, "ids", "left").where(F.coalesce(~taken, F.lit(True))).drop("longer")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """Each lang's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    docs = pick(docs, "lang", "text")
    counts = word_counts(docs, least)
    words = vocabulary(counts)
    n_words, n_all = (words.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first())
    encoded = write_stage(encode(docs, words, n_words <= broadcast_words), "phrase-ids")
    grams, shorter = words.select(F.array("id").alias("ids"), "f"), None
    for size in range(2, LONGEST + 1):
        lay = Layout(size, max(1, int(n_words).bit_length()))
        bits = min(max(0, lay.quotient - 3), max(0, (int(n_all) // SLICE).bit_length()))
        slices = count(encoded, lay, bits, least, shorter)
        grams = grams.unionByName(entries(slices, lay))
        if size < LONGEST:
            shorter = (lay, occupancy(slices, lay, bits))
    grams = write_stage(grams, "phrase-grams")
    kept = independent(write_stage(scored(grams), "phrase-scores"))
    of_lang = words.select(F.col("id").alias("first"), "lang")
    kept = kept.withColumn("first", F.get("ids", F.lit(0))).join(of_lang, "first").drop("first")
    # the best by numbers alone, ties whole, before words are fetched
    near = kept.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).where(F.col("place") <= top)
    near = write_stage(near.drop("place"), "phrase-top")
    text = (near.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id").groupBy("ids")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    n = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    return (near.join(text, "ids").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).join(n, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
