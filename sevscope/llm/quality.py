"""Quality rules: a threshold table compiled into one native projection.

``measure`` adds the counts, ``judge`` turns the table ``RULES`` into one boolean
expression. No shuffle, no user function: a document is judged where it is read.

Defined results: a NULL text counts as empty (no words: the base rule fails and the
document is not kept); a ratio whose denominator is zero counts as 0; repeated rows are
judged alike, row by row; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Common function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine im ist mit nicht sich und von zu "
    "au dans de des du en est et la le les pour que qui sur un une "
    "al como con del el en es la las los no para por que se su un una y").split()

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


class Rule(NamedTuple):
    """``part / whole`` must lie in [low, high] for texts of ``from_words`` words or more."""

    name: str
    part: str
    whole: str
    low: float
    high: float
    from_words: int


#: One row per rule; the whole table becomes one expression.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 12.0, 1),
    Rule("symbols_per_word", "n_symbols", "n_words", 0.0, 0.25, 1),
    Rule("shouts_per_word", "n_shouts", "n_words", 0.0, 0.25, 1),
    Rule("stop_words", "n_stop_words", "n_words", 0.04, 1.0, 50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 0.0, 0.4, 1),
)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of the rules: n_words, word_chars, n_symbols, n_shouts,
    n_stop_words, n_lines, n_dup_lines, n_repeat_words (all long).

    n_repeat_words counts the words inside 5-word windows found twice or more in the text.
    Windows are compared by a 64-bit hash of their five words (two different windows of one
    text of n words agree with a chance below n^2 / 2^65); only texts with an equal pair sort.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    out = (docs.withColumn("__t", t).withColumn("__w", words(F.col("__t"))).withColumn("__l", lines)
           .withColumn("__n", F.size("__w")))
    ws, n = F.col("__w"), F.col("__n")
    # the last four windows are shorter; each differs from all others in length, so none repeats
    out = out.withColumn("__h", F.transform(ws, lambda w, i: F.xxhash64(w, *(F.get(ws, i + k) for k in range(1, WINDOW)))))
    h = F.col("__h")
    ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    out = out.withColumn("__s", F.when(F.size(F.array_distinct(h)) < F.size(h), ordered))
    s = F.col("__s")
    again = F.filter(s, lambda x, j: F.get(s, j - 1)["h"].eqNullSafe(x["h"]) | F.get(s, j + 1)["h"].eqNullSafe(x["h"]))
    at = F.sort_array(F.transform(again, lambda x: x["p"]))
    covered = F.aggregate(
        at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + WINDOW - F.greatest(a["end"] - p, F.lit(0))).alias("n"), (p + WINDOW).alias("end")),
        lambda a: a["n"])
    long = lambda c: c.cast("long")
    return out.select(
        *docs.columns, long(n).alias("n_words"),
        long(F.length(F.array_join(ws, ""))).alias("word_chars"),
        long(F.regexp_count("__t", F.lit(f"[{SYMBOLS}]"))).alias("n_symbols"),
        long(F.regexp_count("__t", F.lit("!"))).alias("n_shouts"),
        long(F.size(F.filter(ws, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(STOP_WORDS)))).alias("n_stop_words"),
        long(F.size("__l")).alias("n_lines"),
        long(F.size("__l") - F.size(F.array_distinct("__l"))).alias("n_dup_lines"),
        long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def passes(rules=RULES) -> Column:
    """The threshold table as one expression over the counts."""
    ok = F.lit(True)
    for r in rules:
        ratio = F.when(F.col(r.whole) > 0, F.col(r.part) / F.col(r.whole)).otherwise(F.lit(0.0))
        ok = ok & ((F.col("n_words") < r.from_words) | ratio.between(r.low, r.high))
    return ok


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per document: the counts, ``base_failed`` and ``kept``."""
    m = measure(pick(docs, "doc_id", "text"))
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed().alias("base_failed"), (~base_failed() & passes(rules)).alias("kept"),
                    "n_shouts", "n_stop_words", "n_lines")


def keep(docs: DataFrame, rules=RULES) -> DataFrame:
    """The documents that pass, with their own columns: the same projection, then a filter.

    The one-element ``explode`` keeps the filter above the counts; pushed below them it would
    repeat the expressions of the words once for each use.
    """
    m = measure(docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("__doc"), docs["text"].alias("text")))
    counts = F.struct(*(c for c in m.columns if c not in ("__doc", "text")))
    m = m.select("__doc", F.explode(F.array(counts)).alias("m")).select("__doc", "m.*")
    return m.where(~base_failed() & passes(rules)).select("__doc.*")
