"""Decontamination against a brute-force scan."""
import hashlib
import random
import re

import pytest

from sevscope.llm import decontam as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(docs, items):
    out = []
    for doc_id, text, *_ in docs:
        w, hit, ids = words(text), set(), set()
        for item, body, *_ in items:
            b = words(body)
            n = min(10, len(b))
            for win in {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else ():
                for s in range(len(w) - n + 1):
                    if tuple(w[s:s + n]) == win:
                        hit.update(range(s, s + n))
                        ids.add(str(item))
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(5)
    voc = [f"w{i}" for i in range(30)] + ["É", "die", "der", "É2"]
    items = [(i, " ".join(rng.choices(voc, k=rng.choice([1, 2, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(20, items[3][1]), (21, None), (22, " .,- "), (23, "the " * 30), (None, "lone item of nobody")]
    docs = []
    for i in range(40):
        t = rng.choices(voc, k=rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            b = words(rng.choice(items)[1])
            at = rng.randrange(len(b) + 1)
            t[len(t) // 2:len(t) // 2] = b[at:at + rng.choice([5, 10, 30])]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(t).replace("w1", "W1")))
    docs += [(3, docs[3][1]), (4, "another text"), (None, None), (None, items[4][1]), (50, ""), (51, "the " * 5000 + "THE"), (None, None)]
    return [(a, b, 1, "x") for a, b in docs], [(a, b, "y") for a, b in items]


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_against_a_scan(spark, broadcast_rows):
    docs, items = fixture()
    d = spark.createDataFrame(docs, "doc_id long, text string, size int, window string")
    b = spark.createDataFrame([x for x in items if x[0] is not None], "item_id long, text string, h string")
    got = sorted(map(tuple, D.report(d, b, broadcast_rows=broadcast_rows).collect()), key=str)
    assert got == plain(docs, [x for x in items if x[0] is not None])
    kept = D.clean(d, b, broadcast_rows=broadcast_rows)
    assert kept.columns == d.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r[0]) for r in got if not r[5])


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in D.report(d, b).collect()] == [(1, 2, 0, 0)]
    assert D.clean(d, b).count() == 1 and D.report(d.where("false"), b).count() == 0


def test_no_python_in_the_plan(spark):
    docs, items = fixture()
    d = spark.createDataFrame(docs, "doc_id long, text string, size int, window string").drop("window")
    b = spark.createDataFrame(items[:10], "item_id long, text string, h string")
    plan = D.report(d, b)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
