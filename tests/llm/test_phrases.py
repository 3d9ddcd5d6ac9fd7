"""Phrases against plain counts, and quotient filters against a dictionary."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sevscope.llm import phrases as P
from sevscope.llm.quotient import Filter, Layout


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def plain(docs, least, top):
    n, f = Counter(), defaultdict(Counter)
    for lang, text, *_ in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            f[lang].update(tuple(ws[i:i + k]) for k in range(1, 5) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            score, _, l, r = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items())
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def fixture():
    rng = random.Random(13)
    voc = ["the", "The", "of", "und", "été", "ÉTÉ", "x y", "\x01odd", "a-b"] + [f"w{i}" for i in range(12)]
    fixed = ["once upon a time", "new york city", "ad hoc", "aa aa aa aa aa"]
    docs = []
    for i in range(120):
        ws = [rng.choice(voc) if rng.random() < 0.7 else rng.choice(fixed) for _ in range(rng.randrange(60))]
        docs.append((rng.choice(["en", "en", "de", None, "und"]), "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for w in ws), "q", 1))
    docs += [docs[0], docs[0], ("fr", None, "q", 1), ("fr", "", None, None), ("en", " .,;", "q", 1), ("it", "solo", "q", 1), (None, "aa " * 3000, "q", 1)]
    return docs


@pytest.mark.parametrize("broadcast_words,top", [(P.BROADCAST_WORDS, 2000), (0, 2000), (P.BROADCAST_WORDS, 7)])
def test_against_plain_counts(spark, broadcast_words, top):
    docs = fixture()
    df = spark.createDataFrame(docs, "lang string, text string, word string, f int").repartition(5)
    got = sorted(map(tuple, P.collocations(df, 6, top, broadcast_words).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))
    assert got == plain(docs, 6, top) and len(got) > 20


def test_small_chunks_and_slices(spark, monkeypatch):
    for name, value in (("CUT", 50), ("CHUNK", 7), ("HELD", 40), ("SLICE", 100)):
        monkeypatch.setattr(P, name, value)
    docs = fixture()
    df = spark.createDataFrame(docs, "lang string, text string, word string, f int").repartition(3)
    assert sorted(map(tuple, P.collocations(df, 6, 50).collect())) == plain(docs, 6, 50)


def test_tables_without_candidates(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert P.collocations(df).count() == 0
    assert P.collocations(spark.createDataFrame([("en", "one two"), (None, None)], "lang string, text string")).count() == 0


@pytest.mark.parametrize("size", [2, 3, 4])
@pytest.mark.parametrize("bits", [1, 3, 9, 18, 25, 32])
def test_filters_lose_nothing(size, bits):
    rng = np.random.default_rng(size * bits)
    span = min(2 ** bits, 40)
    ids = [rng.integers(0, span, 1500) + (2 ** bits - span) for _ in range(size)]
    want, lay = Counter(zip(*(x.tolist() for x in ids))), Layout(size, bits)
    whole = Filter.of(lay, ids)
    again = Filter.from_bytes(lay, whole.to_bytes())
    assert Counter({tuple(g): n for g, n in zip(lay.unpack(again.a, again.b).tolist(), again.n.tolist())}) == want
    depth = min(3, lay.quotient)
    parts = [Filter.from_bytes(lay, p.to_bytes()) for _, p in whole.slices(depth)]
    merged = Filter.merge(lay, [*parts, whole, Filter.of(lay, [x[:0] for x in ids])])
    assert (merged.n == 2 * whole.n).all() and (merged.a == whole.a).all() and (merged.b == whole.b).all()
    for number, part in whole.slices(depth):
        flags = np.unpackbits(np.frombuffer(part.occupied(depth, number), np.uint8), count=1 << (lay.quotient - depth))
        assert flags.sum() == len(set(lay.quotients(part.a, part.b).tolist()))
    assert len(Filter.from_bytes(lay, Filter.of(lay, [x[:0] for x in ids]).to_bytes())) == 0


def test_counters_pass_a_byte():
    lay = Layout(2, 9)
    f = Filter.of(lay, [np.full(70_000, 3), np.full(70_000, 5)])
    g = Filter.from_bytes(lay, Filter.merge(lay, [f] * 3).to_bytes())
    assert g.n.tolist() == [210_000] and lay.unpack(g.a, g.b).tolist() == [[3, 5]]
