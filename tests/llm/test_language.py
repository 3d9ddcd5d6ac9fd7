"""Language profiles against a plain count with tuples of characters."""
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from sevscope.llm import language as L


def grams(text):
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        w = f" {word} "
        out.update(w[i:i + k] for k in (1, 2, 3) for i in range(len(w) - k + 1) if w[i:i + k] != " " and (k < 3 or w[i + 1] != " "))
    return out


def first(c, keep):
    return sorted(c, key=lambda g: (-c[g], len(g), g))[:keep]


def plain(docs, keep):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0
    learned = defaultdict(Counter)
    for i, text, lang, *_ in docs:
        if not held(i) and lang is not None:
            learned[lang].update(grams(text))
    places = {lang: {g: k for k, g in enumerate(first(c, keep))} for lang, c in learned.items() if c}
    out = []
    for i, text, *_ in docs:
        own = first(grams(text), keep)
        d = sorted((sum(abs(k - p[g]) if g in p else keep for k, g in enumerate(own)), lang) for lang, p in places.items()) if own else []
        second = d[1][0] if len(d) > 1 else keep * len(own)
        out.append((i, held(i), d[0][1] if d else "und", (second - d[0][0]) / second if d and second else 0.0))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(12)
    voices = {"a": "the of and ing tion er", "b": "der die und ung ich äß", "c": "le la ès tion ço ment", "d": "И в на не что", "é": "o a que ão os"}
    docs = []
    for i in range(150):
        lang = rng.choice(list(voices))
        ws = ["".join(rng.choices(voices[lang].split(), k=rng.randint(1, 3))) for _ in range(rng.randrange(40))]
        docs.append((i, "".join(rng.choice([w, w.upper(), w.title()]) + rng.choice([" ", "  ", ", ", "1", "_", "\n"]) for w in ws), rng.choice([lang, lang, lang, None]), "s"))
    docs += [docs[0], docs[0], (1, "other text", "a", "s"), (None, "der und", "b", None), (None, None, None, None), (501, None, "a", "s"),
             (502, "", "a", "s"), (503, "12 _ !", "zz", "s"), (504, "the " * 20_000, "a", "s"), (505, "\U00010400\U00010428 ẞ", None, "s")]
    return docs


@pytest.mark.parametrize("keep,langs", [(300, 256), (20, 2), (20, 1)])
def test_against_plain_counts(spark, keep, langs):
    docs = fixture()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, best string").repartition(4)
    known = df.select("doc_id", "text", "lang").where(~L.held_out())
    got = [tuple(r) for r in L.predict(df, L.profiles(known, keep), keep, langs).collect()]
    want = plain(docs, keep)
    assert sorted(got, key=str) == want
    assert {"a", "b", "c", "d", "é", "und"} == {r[2] for r in want}


def test_long_texts_are_cut_without_loss(monkeypatch):
    text = " ".join(random.Random(4).choices(["one", "two three", "Été", "x1y", "-"], k=500)) + "  "
    whole = L.grams(text)
    monkeypatch.setattr(L, "CUT", 11)
    cut = L.grams(text)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_tables_without_languages(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.identify(df).count() == 0
    df = spark.createDataFrame([(1, "some text", None), (2, None, "a")], "doc_id long, text string, lang string")
    assert sorted(r[2:] for r in map(tuple, L.identify(df).collect())) == [("und", 0.0), ("und", 0.0)]
