"""The pipeline against the stages' plain counterparts."""
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_decontam import plain as leaks
from tests.llm.test_simhash import groups, plain as simhash, signed

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = P.table(spark, SF, "documents")
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    kept, seen = [], docs
    for name, stage in P.STAGES:
        seen = P.write_stage(stage(spark, seen, SF), f"test-{name}")
        kept.append(seen)
        assert set(docs.columns) <= set(seen.columns) and (name == "shard" or seen.columns == docs.columns)
    good, one, clean, mixed, sharded = ([r.doc_id for r in k.select("doc_id").collect()] for k in kept)

    texts = {r.doc_id: r.text for r in docs.collect()}
    fp = {i: signed(simhash(texts[i])) for i in good}
    root, first = groups(sorted(set(fp.values()))), {}
    for i in sorted(good):
        first.setdefault(root[fp[i]], i)
    assert sorted(one) == sorted(first.values())

    items = [tuple(r) for r in P.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    bad = {r[0] for r in leaks([(i, texts[i]) for i in one], items) if r[5]}
    assert sorted(clean) == sorted(set(one) - bad) and bad
    assert set(mixed) <= set(clean) and max(Counter(mixed).values()) <= 3
    assert Counter(sharded) == Counter(mixed)
    assert kept[-1].groupBy("shard").agg((F.max("slot") + 1 == F.count("*")).alias("gapless")).where("not gapless").count() == 0


def test_run_gives_the_same(spark):
    assert P.run(spark, SF).count() > 0


def test_run_on_odd_tables(spark, tmp_path):
    """NULLs in every column, repeated rows, a huge text, clashing columns, empty tables."""
    docs, items = P.table(spark, SF, "documents"), P.table(spark, SF, "benchmark")
    names = ("size", "part", "slot", "words", "h", "fp", "slice", "__id", "ahead")
    few = docs.orderBy("doc_id").limit(60).withColumns({c: F.col("doc_id").cast("string") for c in names})
    nothing = few.limit(1).select(*(F.lit(None).cast(t).alias(c) for c, t in few.dtypes))
    huge = few.limit(1).withColumns({"doc_id": F.lit(10**6).cast(dict(few.dtypes)["doc_id"]), "text": F.repeat(F.lit("the one and only long text of many words "), 20_000)})
    nameless = few.withColumn("doc_id", F.lit(None).cast(dict(few.dtypes)["doc_id"])).withColumn("h", F.lit("copy"))
    odd = few.unionByName(few).unionByName(nothing).unionByName(huge).unionByName(nameless)

    def run(name, d, b):
        for table, rows in (("documents", d), ("benchmark", b)):
            rows.write.parquet(f"{tmp_path}/{name}/{table}.parquet")
        return P.run(spark, f"{tmp_path}/{name}")

    plain = run("plain", few, items).collect()
    out = run("odd", odd, items)
    assert sorted(out.columns) == sorted({*few.columns, "shard", "slot"})
    rows = out.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in plain} and plain
    assert all(r.h == r.size == r["__id"] == str(r.doc_id) for r in rows)
    assert max(Counter(r.doc_id for r in rows).values()) <= 3
    none = run("none", odd.where("false"), items)
    assert none.count() == 0 and none.columns == out.columns
    assert {r.doc_id for r in rows} <= {r.doc_id for r in run("no-items", odd, items.where("false")).collect()}
