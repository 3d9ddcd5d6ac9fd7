"""Token counts as an exact length histogram.

Each text's encoded length is counted where it is read; documents are summed by length before
the shuffle, so what moves is one row per length and task. Suffix sums over the lengths then
answer totals, quantiles and truncated totals for every context limit: at limit L the documents
of at most L tokens give all of theirs, the others L each.

Defined results: NULL and empty texts have 0 tokens; repeated rows count each; an empty table
gives an empty histogram; a document counts by its whole text; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import Bpe, count_tokens
from .common import pick


def token_counts(docs: DataFrame, bpe: Bpe) -> DataFrame:
    """(doc_id, n_tokens) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(bpe)  # the vocabulary: a fixed size

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = sent.value.encoder()
        for s in texts:
            yield pd.Series([count_tokens(encoding, t) if t else 0 for t in s], dtype="int64")

    return pick(docs, "doc_id", "text").select("doc_id", count("text").alias("n_tokens"))


def histogram(counts: DataFrame) -> DataFrame:
    """(n_tokens, docs): documents of each length."""
    return counts.groupBy("n_tokens").agg(F.count("*").alias("docs"))


def answers(hist: DataFrame) -> DataFrame:
    """For every length as a context limit: documents of that length, up to it and over it, tokens of
    those up to it, the truncated total, and the share of documents up to it. The window has one
    row per distinct length, however many documents there are."""
    over = Window.orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)  # suffix sums
    every = Window.partitionBy()
    own = F.col("n_tokens") * F.col("docs")
    h = (hist.withColumn("docs_over", F.coalesce(F.sum("docs").over(over), F.lit(0)))
         .withColumn("tokens_over", F.coalesce(F.sum(own).over(over), F.lit(0)))
         .withColumn("all_docs", F.sum("docs").over(every)).withColumn("all_tokens", F.sum(own).over(every)))
    up_to = F.col("all_tokens") - F.col("tokens_over")
    return h.select("n_tokens", "docs", (F.col("all_docs") - F.col("docs_over")).alias("docs_up_to"), "docs_over", up_to.alias("tokens_up_to"),
                    (up_to + F.col("n_tokens") * F.col("docs_over")).alias("truncated_total"),
                    ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile"))


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """One row: the truncated total of any limits, as columns ``upto_<limit>``."""
    return hist.agg(*(F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(x)) * F.col("docs")), F.lit(0)).alias(f"upto_{x}") for x in limits))


def quantile(hist: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length that a share ``q`` of the documents does not exceed."""
    return answers(hist).where(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n_tokens"))
