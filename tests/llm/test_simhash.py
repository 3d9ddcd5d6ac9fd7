"""SimHash: fingerprints against a plain count, components against brute force."""
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from sevscope.llm import simhash as S

SCHEMA = "doc_id long, text string, fp int, value string"


def plain(text):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    s = [b" ".join(w)] if len(w) < 3 else [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s if x]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def groups(fps):
    """Root (smallest, signed) of each fingerprint by comparing all pairs."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in fps:
        for b in fps:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def signed(x):
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def near(rng, n):
    """Random fingerprints, chains and dense balls, a half shared by many."""
    out = [rng.getrandbits(64) for _ in range(n)]
    for c in out[:4]:
        x = c
        for _ in range(20):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])))
            out.append(x)
        out += [c ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(30)]
    low = out[0] & 0xFFFFFFFF
    out += [rng.getrandbits(32) << 32 | low for _ in range(40)]
    return sorted({signed(x) for x in out})


@pytest.mark.parametrize("bucket", [1, 4, 10_000])
def test_components_against_all_pairs(spark, bucket):
    fps = near(random.Random(bucket), 60)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.root for r in S.components(S.links(df, bucket)).collect()}
    want = groups(fps)
    assert {f: got.get(f, f) for f in fps} == want
    assert len(set(want.values())) < len(fps)


def test_small_buckets_give_every_link(spark):
    fps = near(random.Random(9), 40)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {(r.a, r.b) for r in S.links(df, 10_000).collect()}
    assert got == {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}


def rows():
    long = " ".join(f"w{i * 7919 % 3001}" for i in range(70_000))
    return [(1, "a b c d", 1, "x"), (2, "A  b\tC d", 1, "x"), (3, None, 1, "x"), (4, "", 1, "x"), (5, " \n ", 1, "x"),
            (6, "one", 1, "x"), (7, "One two", 1, "x"), (7, "One two", 1, "x"), (None, "a b c d", 1, "x"),
            (None, "quite other words here", 1, "x"), (8, "É É é É", 1, "x"), (9, long, 1, "x"), (10, long + " z", 1, "x")]


def test_documents(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = S.near_duplicates(df).collect()
    assert len(got) == len(rows())
    fp = {r.doc_id: r.fingerprint for r in got if r.doc_id}
    assert fp == {i: f"{plain(t):016x}" for i, t, *_ in rows() if i}
    comp = {r.doc_id: r.component_id for r in got if r.doc_id}
    assert comp[2] == 1 and comp[4] == comp[5] == 3 and comp[7] == 7 and comp[10] == 9
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["1", "None"]


def test_keep_one_of_each_component(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = S.keep_one(df)
    assert got.columns == df.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(["1", "3", "6", "7", "8", "9", "None"])
    assert S.keep_one(df.where("false")).count() == 0 and S.near_duplicates(df.where("false")).count() == 0


def test_rows_of_one_id_with_other_texts_stay(spark):
    df = spark.createDataFrame([(1, "a b c d e f g", 1, ""), (1, "p q r s t u v", 1, ""), (1, "p q r s t u v", 1, "")], SCHEMA)
    assert sorted(r.text for r in S.keep_one(df).collect()) == ["a b c d e f g", "p q r s t u v"]


def test_choice_among_rows_alike(spark):
    """Rows alike in doc_id and text: the smallest other columns, NULL first, whatever the row order."""
    rows_ = [(1, "a b c d", x, {"k": y}) for x, y in ((2, 1), (1, 9), (1, 3), (5, 0))] + [(2, "p q r s t", 4, None), (2, "p q r s t", None, {"z": 1})]
    for own in (rows_, rows_[::-1]):
        df = spark.createDataFrame(own, "doc_id long, text string, other int, m map<string,int>").repartition(3)
        assert sorted((r[0], r[2], r[3]["k"] if r[3] and "k" in r[3] else None) for r in S.keep_one(df).collect()) == [(1, 1, 3), (2, None, None)]


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = dict(df.select("doc_id", "text").collect())
    fp = {i: signed(plain(t)) for i, t in texts.items()}
    root = groups(sorted(set(fp.values())))
    first = {}
    for i in sorted(fp):
        first.setdefault(root[fp[i]], i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect()}
    assert got == {i: (f"{f & (1 << 64) - 1:016x}", first[root[f]]) for i, f in fp.items()}
