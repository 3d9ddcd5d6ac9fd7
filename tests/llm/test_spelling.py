"""Spelling variants against plain comparison of all words."""
import random
import re
import zlib
from collections import Counter

import pytest

from sevscope.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(docs):
    n = Counter()
    for doc_id, text, *_ in docs:
        for run in map(lower, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [x for x in n if one_apart(w, x)] for w in n}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], form[w], root, len(near[w]), n.get(form[w])))
    return sorted(out)


def fixture():
    rng = random.Random(11)
    words = ["abababa", "abababab", "bababab", "Étienne", "éléphant", "ÉLÉPHANT", "straßeÿx", "a" * 3000, "a" * 2999 + "b", "short", "naïveté÷"]
    for _ in range(60):  # words around each other at one and two letters
        w = list(rng.choice(words[:7]))
        w[rng.randrange(len(w))] = rng.choice("abé")
        words.append("".join(w) + rng.choice(["", "a", "b"]))
    docs = [(i, " ".join(rng.choices(words, [400 // (1 + k) for k in range(len(words))], k=rng.randrange(200))), "x", 1) for i in range(40)]
    docs += [(3, docs[3][1], "x", 1), docs[5], (None, "abababa abababa Abababa", None, None), (90, None, None, None), (91, "", "y", 2), (92, "1 2 - Ÿ ", "y", 2)]
    chain = "kettenglied"  # 2, 20, 200 and 2000 times, one letter apart each
    for k, times in enumerate((2000, 200, 20, 2)):
        docs += [(1000 * (k + 1) + i, chain[:len(chain) - k] + "x" * k, "z", 1) for i in range(times)]
    return docs


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_against_all_pairs(spark, block):
    docs = fixture()
    df = spark.createDataFrame(docs, "doc_id long, text string, word string, n int")
    got = sorted(map(tuple, S.variants(df, block).collect()))
    want = plain(docs)
    assert got == want
    chained = {r[0]: r[3] for r in want if r[2]}
    assert any(dict((r[0], r[2]) for r in want)[w] != root for w, root in chained.items())  # a chain of two links


def test_near_words_of_one_block():
    rng = random.Random(3)
    for _ in range(200):
        low = rng.randrange(5)
        words = sorted({"".join(rng.choices("ab", k=rng.choice([low, low + 1]))) for _ in range(12)})
        veto = rng.randint(0, low)
        got = {i: (n, j) for i, n, j in S.near_words(words, veto, low)}
        for i, w in enumerate(words):
            ok = [j for j, x in enumerate(words) if one_apart(w, x) and low in (len(w), len(x)) and not (veto and w[:veto] == x[:veto])]
            assert got.get(i, (0, None)) == (len(ok), ok[0] if ok else None)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.variants(df).columns == ["word", "n", "form", "root", "n_near", "form_n"]
    assert S.variants(df).count() == 0
