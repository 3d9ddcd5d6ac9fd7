"""Language identification by rank-order profiles of character n-grams.

A profile is the ``KEEP`` most frequent n-grams (1 to 3 characters; letters in lower case, words set off by a
blank) in order. A language's profile comes from all texts that are known to be in it; a text is compared to
every profile by the out-of-place distance: for each n-gram of the text's own profile the difference of its
places, or ``KEEP`` where the language's profile lacks it. The nearest profile names the language.

Learning counts n-grams in each task and sums them per (lang, n-gram), so what moves is bounded by the alphabet and not
by the texts. Prediction is a map over the texts. Profiles are broadcast ``LANGS`` languages at a time; with
more of them the texts pass one such block after the other.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, as is every text if no language could
be learned; equal counts are ordered shorter n-gram first, then by code point; equal distances go to the first
language in order; a NULL doc_id counts as an empty string (held out); repeated rows are judged row by row; an
empty table gives no rows; other columns are not read.
"""
from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sevscope.session import write_stage

from .common import pick

KEEP = 300
#: Languages whose profiles are broadcast together.
LANGS = 256
#: Rows whose crc32 of the doc_id leaves remainder 0 are never learned from.
FOLDS = 5
#: Characters that are counted at once, n-grams that a task holds.
CUT, HELD = 1_000_000, 300_000
_BITS = 21
#: The nearest language so far, its distance and that of the second.
STATE = "best string, distance long, second long"
_BLANK = 32


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys summed, in order."""
    at = np.argsort(keys, kind="stable")
    keys, counts = keys[at], counts[at]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(counts, starts) if len(counts) else counts


def _stretches(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        gap = re.compile(r"\s").search(text, at + CUT)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text, packed to 21 bits a character, and their counts."""
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for some in _stretches(text or ""):
        c = np.frombuffer(f" {some.lower()} ".encode("utf-32-le"), np.uint32).astype(np.int64)
        c = np.where(_letters()[c], c, _BLANK)
        c = c[(c != _BLANK) | (np.append(0, c[:-1]) != _BLANK)]  # one blank for all that stands between words
        two = c[:-1] << _BITS | c[1:]
        three = two[:-1] << _BITS | c[2:]
        parts.append(np.unique(np.concatenate([c[c != _BLANK], two, three[c[1:-1] != _BLANK]]), return_counts=True))
    return parts[-1] if len(parts) < 3 else _sum(*map(np.concatenate, zip(*parts)))


def top(keys: np.ndarray, counts: np.ndarray, keep: int) -> np.ndarray:
    """The most frequent keys in order of (falling count, key)."""
    if len(keys) > keep:
        least = np.partition(counts, len(counts) - keep)[len(counts) - keep]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.lexsort((keys, -counts))][:keep]


def held_out() -> Column:
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % FOLDS == 0


def profiles(docs: DataFrame, keep: int = KEEP) -> DataFrame:
    """(lang, gram, place): the profile of every lang value of ``docs``, from all their texts. Written."""
    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows() -> Iterator[pd.DataFrame]:
            for lang, (k, n) in held.items():
                yield pd.DataFrame({"lang": lang, "gram": k, "n": n})
            held.clear()

        for batch in it:
            for lang, texts in batch.groupby("lang")["text"]:
                parts = [grams(t) for t in texts] + ([held[lang]] if lang in held else [])
                held[lang] = _sum(*map(np.concatenate, zip(*parts)))
            if sum(len(k) for k, _ in held.values()) > HELD:
                yield from rows()
        yield from rows()

    known = docs.select(docs["lang"].cast("string").alias("lang"), docs["text"].alias("text")).where("lang is not null and text is not null")
    sums = known.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return write_stage(sums.withColumn("place", place).where(F.col("place") <= keep).select("lang", "gram", (F.col("place") - 1).alias("place")), "language-profiles")


class Table:
    """Profiles of some languages, in order of name: sorted n-grams and their places."""

    def __init__(self, rows: pd.DataFrame, keep: int):
        self.keep = keep
        self.langs = sorted(rows["lang"].unique())
        self.grams, at = np.unique(rows["gram"].to_numpy(np.int64), return_inverse=True)
        self.places = np.full((len(self.grams), len(self.langs)), -1, np.int64)
        self.places[at, rows["lang"].map({x: i for i, x in enumerate(self.langs)})] = rows["place"]

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a text's n-grams, in order, to every language."""
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = np.flatnonzero(self.grams[at] == own)
        places = self.places[at[known]]
        off = np.where(places < 0, self.keep, np.abs(places - known[:, None]))
        return off.sum(axis=0) + self.keep * (len(own) - len(known))


def _nearest(sent: Broadcast, keep: int):
    """The nearest language of a text, given the nearest of the languages before."""
    @F.pandas_udf(STATE)
    def nearest(it: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, best, distance, second in it:
            rows = []
            for text, b, d, s in zip(texts, best, distance, second):
                own = top(*grams(text), keep)
                if not len(own):
                    rows.append((None, None, None))
                    continue
                found = list(zip(sent.value.distances(own).tolist(), sent.value.langs))
                found += [] if pd.isna(d) else [(int(d), b)]
                near = min(found)
                others = sorted([x for x, _ in found] + ([] if pd.isna(s) else [int(s)]))[1:]
                rows.append((near[1], near[0], others[0] if others else keep * len(own)))
            yield pd.DataFrame(rows, columns=["best", "distance", "second"]).astype({"distance": "Int64", "second": "Int64"})

    return nearest


def predict(docs: DataFrame, learned: DataFrame, keep: int = KEEP, langs: int = LANGS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row. The score is the share by which the second nearest profile
    is farther (with a single profile: by which that is nearer than one without a common n-gram)."""
    sc = docs.sparkSession.sparkContext
    names = [r["lang"] for r in learned.select("lang").distinct().orderBy("lang").collect()]
    out = pick(docs, "doc_id", "text").select(
        "doc_id", held_out().alias("held_out"), "text",
        F.lit(None).cast("string").alias("best"), F.lit(None).cast("long").alias("distance"), F.lit(None).cast("long").alias("second"))
    for at in range(0, len(names), langs):
        sent = sc.broadcast(Table(learned.where(F.col("lang").isin(names[at:at + langs])).toPandas(), keep))

        out = out.withColumn("state", _nearest(sent, keep)("text", "best", "distance", "second")).select("doc_id", "held_out", "text", "state.*")
    score = F.when(F.col("second") > 0, (F.col("second") - F.col("distance")) / F.col("second")).otherwise(0.0)
    return out.select("doc_id", "held_out", F.coalesce("best", F.lit("und")).alias("lang_pred"), F.coalesce(score, F.lit(0.0)).alias("score"))


def identify(docs: DataFrame) -> DataFrame:
    """Every document's language, learned from the documents that are not held out."""
    docs = pick(docs, "doc_id", "text", "lang")
    return predict(docs, profiles(docs.where(~held_out())))
