"""Toxicity scores of whole texts by a bidirectional gated recurrent network (``bigru``).

Fit. The labelled rows that may be learned from are reduced to ``FIT_ROWS`` of each class, those of
the smallest hash, and of these to texts of ``FIT_CHARS`` characters at most: the documented bound of
the sample that trains the network on the driver. Labels are of documents, so the windows that
carry a label are found in two rounds: first those with the words most typical of the label's
documents, then those that the network itself scores highest.

Score. Every text is cut into overlapping windows of 16 words, 8 apart, to its end; the score is
that of the highest window, calibrated on the sample's documents. Inputs are the text's words and
characters only.

Defined results: NULL and empty texts and texts without letters or digits score 0; a label row
that repeats counts as its largest label; without both labels in the sample every score is 0;
repeated rows score alike, row by row; an empty table gives an empty result.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bigru import BLOCK, LENGTH, TRIGRAMS, Network, train, trigrams, window_starts
from .common import pick

FIT_ROWS = 1500
FIT_CHARS = 20_000
STRIDE = 8
STEPS = 200
VOCABULARY = 20_000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
#: Distinct words whose inputs a task keeps.
CACHE = 100_000
#: Words of texts that are scored together.
TOGETHER = 200_000

WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Scorer:
    """A trained network with its calibration; sent to the tasks (about 2 MB, whatever the data)."""

    def __init__(self, net: Network | None, scale: float = 1.0, shift: float = 0.0):
        self.net, self.scale, self.shift = net, scale, shift
        self._ids: dict[str, int] = {}
        self._proj = np.zeros((0, 0), np.float32)

    def __getstate__(self):
        return {"net": self.net, "scale": self.scale, "shift": self.shift, "_ids": {}, "_proj": np.zeros((0, 0), np.float32)}

    def _lookup(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of ``_proj`` for the words of each text."""
        if len(self._ids) > CACHE:
            self._ids, self._proj = {}, np.zeros((0, 0), np.float32)
        ids, known = self._ids, len(self._ids)
        out = [np.fromiter((ids.setdefault(w, len(ids)) for w in t), np.int64, len(t)) for t in texts]
        if len(ids) > known:
            new = self.net.inputs(*self.net.encode(list(ids)[known:]))[1]
            self._proj = np.concatenate([self._proj, new]) if known else new
        return out

    def best(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Highest logit of each text's windows, and where that window starts; texts have words."""
        ids = self._lookup(texts)
        ahead = np.cumsum([0] + [len(x) for x in ids])
        starts = [window_starts(len(x), STRIDE) for x in ids]
        text_of = np.repeat(np.arange(len(ids)), [len(s) for s in starts])
        flat, start = np.concatenate(ids), np.concatenate(starts)
        logit = np.empty(len(start), np.float32)
        for at in range(0, len(start), BLOCK):
            t, s = text_of[at:at + BLOCK], start[at:at + BLOCK]
            place = (ahead[t] + s)[:, None] + np.arange(LENGTH)
            inside = place < ahead[t + 1][:, None]
            logit[at:at + BLOCK] = self.net.forward(self._proj, flat[np.minimum(place, len(flat) - 1)], inside.astype(np.float32))
        first = np.searchsorted(text_of, np.arange(len(ids)))
        top = np.maximum.reduceat(logit, first)
        where = [start[a:a + len(s)][np.argmax(logit[a:a + len(s)])] for a, s in zip(first, starts)]
        return top, np.array(where)

    def scores(self, texts) -> np.ndarray:
        """A score for each text, taking as many together as bound the memory."""
        out = np.zeros(len(texts))
        held, of, n = [], [], 0

        def flush():
            if held:
                out[of] = 1 / (1 + np.exp(-np.clip(self.scale * self.best(held)[0].astype(float) + self.shift, -30, 30)))
                held.clear(), of.clear()
        if self.net is None:
            return out
        for i, t in enumerate(texts):
            w = words(t)
            if w:
                held.append(w)
                of.append(i)
                n += len(w)
            if n > TOGETHER:
                flush()
                n = 0
        flush()
        return out


def fit(texts: list[str], labels: list[int], seed: int = 7) -> Scorer:
    """A scorer from a bounded sample of labelled texts."""
    docs = [(words(t), y) for t, y in zip(texts, labels)]
    docs = [(w, y) for w, y in docs if w]
    n = Counter(y for _, y in docs)
    if not n[0] or not n[1]:
        return Scorer(None)
    rng = np.random.default_rng(seed)
    # words, and the characters of words, by how much more often label 1 has them; few occurrences say little
    parts = [({*w}, {t for x in {*w} for t in trigrams(x)}, y) for w, y in docs]
    typical, grams = ({x: odds * c / (c + 5) for x, (odds, c) in _odds([(p[k], p[2]) for p in parts], n).items()} for k in (0, 1))
    common = [x for x, c in Counter(x for p in parts for x in p[0]).most_common(VOCABULARY) if c > 1]
    net = Network({x: i + 1 for i, x in enumerate(common)}).start(
        rng, np.array([0.0] + [typical[x] / 2 for x in common]), np.array([grams.get(t, 0.0) / 2 for t in range(TRIGRAMS)]))
    telling = {x: max(typical[x], *(grams[t] for t in trigrams(x))) for x in typical}

    def examples(first, told):
        """Windows and labels: of each text that is ``told`` the window ``first`` names, and of texts of label 0 more."""
        out, label = [], []
        for (w, y), at, ok in zip(docs, first, told):
            if not ok:
                continue
            out.append(w[at:at + LENGTH])
            label.append(y)
            if y == 0:
                for s in rng.choice(window_starts(len(w), STRIDE), 3):
                    out.append(w[s:s + LENGTH])
                    label.append(0)
        return out, label

    def most_typical(w):
        s = window_starts(len(w), STRIDE)
        return int(s[np.argmax([max(telling[x] for x in w[a:a + LENGTH]) for a in s])])
    train(net, examples([most_typical(w) for w, _ in docs], [True] * len(docs)), STEPS, rng)
    scorer = Scorer(net)
    label = np.array([y for _, y in docs])
    for _ in range(2):
        top, where = _tops(Scorer(net), docs)
        # a document of label 1 whose highest window stands out from none of label 0 teaches nothing
        told = (label == 0) | (top > np.quantile(top[label == 0], 0.8))
        train(net, examples(where, told | (not told[label == 1].any())), STEPS // 2, rng, rate=0.003)
    scorer = Scorer(net)
    scorer.scale, scorer.shift = calibrate(_tops(scorer, docs)[0].astype(float), label.astype(float))
    return scorer


def _odds(parts, n) -> dict:
    """Log odds of label 1 and the number of documents of everything in ``parts`` (sets and labels)."""
    seen = {y: Counter(x for own, z in parts if z == y for x in own) for y in (0, 1)}
    return {x: (float(np.log((seen[1][x] + 0.5) / (n[1] + 1)) - np.log((seen[0][x] + 0.5) / (n[0] + 1))), c)
            for x, c in (seen[0] + seen[1]).items()}


def _tops(scorer: Scorer, docs) -> tuple[np.ndarray, np.ndarray]:
    """``best`` of the sample's documents, some at a time."""
    parts = [scorer.best([w for w, _ in docs[a:a + 200]]) for a in range(0, len(docs), 200)]
    return np.concatenate([t for t, _ in parts]), np.concatenate([w for _, w in parts])


def calibrate(logit: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through the documents' highest logits; a little ridge keeps it finite."""
    mean, spread = logit.mean(), logit.std() + 1e-6
    x = np.stack([(logit - mean) / spread, np.ones_like(logit)], axis=1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.1, 0.01])
        w += np.linalg.solve(h, x.T @ (label - p) - np.array([0.1, 0.01]) * w)
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> tuple[list[str], list[int]]:
    """Texts and labels to learn from: at most ``rows`` of each label, of at most ``chars`` characters."""
    lab = (pick(labels, "doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = lab.where("toxic = 1").orderBy(*order).limit(rows).unionByName(lab.where("toxic = 0").orderBy(*order).limit(rows))
    got = (pick(docs, "doc_id", "text").where(F.length("text") <= chars).join(F.broadcast(ids), "doc_id")  # 2 * rows ids
           .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id").collect())
    return [r["text"] for r in got], [int(r["toxic"]) for r in got]


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(sent.value.scores(s.tolist()))

    scored = pick(docs, "doc_id", "text").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), run("text").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
