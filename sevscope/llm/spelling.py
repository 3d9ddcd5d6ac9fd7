"""Spelling variants: words at edit distance one, found with bit-sliced position indexes.

Over a set of words, the index has one bitset per (position, letter): the words with that letter there.
Reading a word letter by letter, four bitsets are carried along at once, in steps that treat all words of
the index in parallel: the words that agree so far (no error), and those with one replaced letter, one
letter more (positions shifted by one) or one letter less (shifted back) so far. Words stand in the
index by falling count, so the lowest set bit of the result is the form and the set bits are the count of near
words: no pair leaves a task.

The vocabulary is cut into blocks that words at distance one share. Two words of length L, or of L and L + 1,
that differ by one letter have the first half of L in common or the last half. So a word goes by its own
length and by the one below to the blocks of its first and last half. A block of more than ``block`` words is
cut again, by the halves of what its words do not yet have in common, until at most one letter is left: then its
size is bounded by the alphabet. Pairs that two blocks share are left out of the second by the set of words
that still agreed after the common first half.

Defined results: NULL and empty texts have no words; a NULL doc_id counts as an empty string in the hash;
repeated rows count each; an empty table gives no rows; ties of forms go to the first word in code-point
order; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sevscope.session import write_stage

from .common import pick

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: a run of letters.
LETTER = "A-Za-z\\u00C0-\\u00FF"
#: One run in so many loses a letter.
DROP = 31
SHORTEST = 7
LEAST = 2
#: A form has so many times the occurrences of its variant.
MARGIN = 10
#: Words of an index.
BLOCK = 4096


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of ``SHORTEST`` letters or more with ``LEAST`` occurrences or more."""
    t = F.coalesce(docs["text"], F.lit(""))
    runs = F.regexp_extract_all(t, F.lit(f"[{LETTER}]{{{SHORTEST},}}+"), F.lit(0))
    d = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    # lower() does it for ASCII, and is faster
    low = F.when(F.length("run") == F.octet_length("run"), F.lower("run")).otherwise(F.translate("run", UPPER, LOWER))
    d = d.select("id", low.alias("run"))
    d = d.select("run", F.crc32(F.encode(F.concat_ws(":", "id", "run"), "UTF-8")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.left("run", at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DROP == 0, short).otherwise(F.col("run"))
    return (d.select(word.alias("word")).where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= LEAST))


def near_words(words: list[str], veto: int, low: int) -> Iterator[tuple[int, int, int]]:
    """For each word, as its place: (place, number of near words, place of the first).

    Words of ``low`` letters meet all, words of one letter more meet only those of ``low``.
    Pairs that agree in the first ``veto`` letters are left out."""
    slots: dict[tuple[int, str], int] = {}
    of_length: dict[int, int] = {}
    for i, w in enumerate(words):
        bit = 1 << i
        of_length[len(w)] = of_length.get(len(w), 0) | bit
        for key in enumerate(w):
            slots[key] = slots.get(key, 0) | bit
    every = (1 << len(words)) - 1
    get = slots.get
    for i, w in enumerate(words):
        same, replaced, more, less = every, 0, 0, 0
        agreed = every if veto == 0 else 0
        for at, letter in enumerate(w):
            here = get((at, letter), 0)
            less = less & get((at - 1, letter), 0) | same
            more = (more | same) & get((at + 1, letter), 0)
            replaced = replaced & here | same & ~here
            same &= here
            if at + 1 == veto:
                agreed = same
        if len(w) == low:
            found = replaced & of_length.get(low, 0) | (more | same) & of_length.get(low + 1, 0)
        else:
            found = less & of_length.get(low, 0)
        if veto:
            found &= ~agreed
        if found:
            yield i, found.bit_count(), (found & -found).bit_length() - 1


def _halves(rows: DataFrame) -> DataFrame:
    """Each row of (word, n, size, head, tail, veto) by the first and by the last half of its free letters."""
    half = ((F.col("size") - F.col("head") - F.col("tail")) / 2).cast("int")
    cut = F.col("head") + half
    no_more = F.when(F.col("veto") > 0, F.least("veto", cut)).otherwise(cut)
    return rows.select("word", "n", "size", F.inline(F.array(
        F.struct(cut.alias("head"), F.col("tail").alias("tail"), F.col("veto").alias("veto")),
        F.struct(F.col("head").alias("head"), (F.col("tail") + half).alias("tail"), no_more.alias("veto")))),
    ).where("veto = 0 or head < veto")


def _free(size: Column) -> Column:
    return size - F.col("head") - F.col("tail")


KEY = ["size", "head", "tail", "veto", "first", "last"]


def blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(size, head, tail, veto, first, last, items): the words of each block by falling count; ``size`` is the
    length of its shorter words, ``first`` and ``last`` are the ``head`` first and ``tail`` last letters they share."""
    sizes = F.array(F.length("word"), F.length("word") - 1)
    rows = words.select("word", "n", F.explode(sizes).alias("size"), F.lit(0).alias("head"), F.lit(0).alias("tail"), F.lit(0).alias("veto"))
    open_rows = rows.where(F.col("size") >= SHORTEST)
    done = None
    while True:
        cut = _halves(open_rows).withColumns({"first": F.left("word", F.col("head")), "last": F.right("word", F.col("tail"))})
        cut = write_stage(cut, "spelling-blocks")
        large = cut.groupBy(*KEY).agg(F.count("*").alias("rows")).where((F.col("rows") > block) & (_free(F.col("size")) > 1)).drop("rows")
        large = write_stage(large, "spelling-large")
        if large.limit(1).count() == 0:
            return cut if done is None else done.unionByName(cut)
        ready = cut.join(large, KEY, "left_anti")
        done = ready if done is None else done.unionByName(ready)
        open_rows = cut.join(large, KEY, "left_semi").drop("first", "last")


def near(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best): how many near words, and the first by (count, word) as struct (n, form); only words with some."""
    item = F.struct((-F.col("n")).alias("less"), "word")
    b = (blocks(words, block).groupBy(*KEY).agg(F.sort_array(F.collect_list(item)).alias("items")).where(F.size("items") > 1)
         .select("size", "head", "tail", "veto", F.transform("items", lambda x: x["word"]).alias("words"), F.transform("items", lambda x: -x["less"]).alias("counts")))

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sizes, heads, tails, vetoes, lists, counts = (c.to_pylist() for c in batch.columns)
            out: list[tuple[str, int, int, str]] = []
            for size, head, tail, veto, ws, ns in zip(sizes, heads, tails, vetoes, lists, counts):
                free = [w[head:len(w) - tail] for w in ws]
                out += [(ws[i], k, ns[j], ws[j]) for i, k, j in near_words(free, max(veto - head, 0), size - head - tail)]
            cols = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                             ["word", "n_near", "form_n", "form"])

    found = b.mapInArrow(search, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form): where following forms ends. A form has ``MARGIN`` times the count of its word, so a
    chain is at most 18 links, which five doublings follow."""
    at = write_stage(links.select("word", F.col("form").alias("root")), "spelling-links")
    for _ in range(5):
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = write_stage(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-links")
        at = step.drop("moved")
        if step.where("moved").limit(1).count() == 0:
            break
    return at


def variants(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every word of the documents: word, n, form, root, n_near, form_n."""
    words = write_stage(vocabulary(pick(docs, "doc_id", "text")), "spelling-words")
    met = words.join(near(words, block), "word", "left")
    is_form = -F.col("best.less") >= MARGIN * F.col("n")
    met = write_stage(met.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"),
                                 F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-near")
    root = roots(met.where(F.col("form").isNotNull()))
    return met.join(root, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")
