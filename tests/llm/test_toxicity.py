"""The network's gradient, its held-out accuracy, and small tables."""
import random

import numpy as np
from pyspark.sql import functions as F

from sevscope.llm import toxicity as X
from sevscope.llm.bigru import LENGTH, Network, window_starts


def test_gradient_against_differences():
    rng = np.random.default_rng(1)
    words = ["ab", "cde", "x", "yz"]
    net = Network({w: i + 1 for i, w in enumerate(words[:3])}).start(rng, np.zeros(4), np.zeros(8192))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    enc, ids = net.encode(words), rng.integers(0, 4, (3, LENGTH))
    mask = np.ones((3, LENGTH))
    mask[1, 5:] = 0
    label, weight = np.array([1.0, 0, 1]), np.ones(3)
    _, g = net.gradients(enc, ids, mask, label, weight)
    for k, v in net.p.items():
        at = np.unravel_index(np.argmax(np.abs(g[k])), v.shape)
        v[at] += 1e-3
        up = net.gradients(enc, ids, mask, label, weight)[0]
        v[at] -= 2e-3
        down = net.gradients(enc, ids, mask, label, weight)[0]
        v[at] += 1e-3
        assert abs((up - down) / 2e-3 - g[k][at]) < 0.02 * abs(g[k][at]) + 1e-4, k


def test_windows_cover_every_word():
    for n in (0, 1, 15, 16, 17, 24, 100, 1003):
        s = window_starts(n, X.STRIDE)
        assert {i for a in s for i in range(a, min(n, a + LENGTH))} == set(range(n))


def test_held_out_accuracy_and_small_tables(spark):
    rng = random.Random(4)
    voc = ["".join(rng.choices("abcdefgh", k=rng.randrange(3, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        w = rng.choices(voc, k=rng.randrange(5, 120))
        y = int(i % 4 == 0)
        for _ in range(2 * y):
            w[rng.randrange(len(w))] = rng.choice(["vile", "rotten", "qux" + rng.choice(voc)])
        rows.append((i, " ".join(w), 1))
        labels += [(i, y, "x")] * (1 + i % 2)
    long = " ".join(rng.choices(voc, k=60_000))
    rows += [(1000, None, 1), (1001, "", 1), (1002, " ... ", 1), (None, "vile rotten", 1), (1003, long + " vile rotten vile", 1), (1004, long, 1), (1004, long, 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, score int")
    lab = spark.createDataFrame([*labels, (None, 1, "x"), (5000, 1, "x"), (1, None, "x")], "doc_id long, toxic int, text string")
    scorer = X.fit(*X.sample(d, lab))
    got = X.score(d, scorer).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [(r.doc_id % 4 == 0, r.predicted) for r in got if r.held_out and r.doc_id < 600]
    assert sum(bool(y) == bool(p) for y, p in held) >= 0.9 * len(held) and len(held) > 80
    assert sum(p for y, p in held if y) >= 0.8 * sum(y for y, _ in held)
    by = {r.doc_id: r.score for r in got}
    assert by[1000] == by[1001] == by[1002] == 0 and by[1003] > by[1004]
    none = X.fit(*X.sample(d, lab.where("toxic = 0")))
    assert {r.score for r in X.score(d.limit(5), none).collect()} == {0.0}
    assert X.score(d.where("false"), scorer).count() == 0
    learned = set(X.sample(d, lab)[0])
    out = {r.text for r in d.where(X.held_out(F.col("doc_id"))).collect()}
    assert not learned & out
