"""Profiles and distribution reports.

All reports are single-pass aggregates; the long ("unpivoted") layouts come from
``stack``-style ``inline`` over an array of structs built inside one aggregate
row, so a report over N columns is still one scan and one tiny shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .groups import join_groups

from ..functions.flags import round1
from ..schema import is_numeric


def group_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row counts by keys (F1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def component_counts(df: DataFrame, flags: list[str]) -> DataFrame:
    """Positive and known (non-NULL) counts per flag."""
    row = df.agg(*[F.struct(F.lit(c).alias("component"),
                            F.sum(c).cast("bigint").alias("positive"),
                            F.count(c).alias("known")).alias(c) for c in flags])
    return row.select(F.inline(F.array(*[F.col(c) for c in flags])))


def component_shares(df: DataFrame, flags: list[str], digits: int = 6) -> DataFrame:
    """Mean of each non-NULL flag."""
    row = df.agg(*[F.struct(F.lit(c).alias("component"),
                            F.round(F.avg(c), digits).alias("share")).alias(c) for c in flags])
    return row.select(F.inline(F.array(*[F.col(c) for c in flags])))


def class_distribution(df: DataFrame, label: str, subsets: dict[str, Column | None],
                       classes=(0, 1)) -> DataFrame:
    """Class counts per subset, zero-filled for absent classes.

    One aggregate with conditional counts - no join is needed for the zero fill.
    """
    aggs = []
    for name, cond in subsets.items():
        for k in classes:
            hit = F.col(label) == F.lit(k)
            if cond is not None:
                hit = hit & cond
            aggs.append(F.struct(F.lit(name).alias("subset"), F.lit(k).alias(label),
                                 F.count_if(hit).alias("n")).alias(f"{name}_{k}"))
    row = df.agg(*aggs)
    return row.select(F.inline(F.array(*[F.col(f"{n}_{k}") for n in subsets for k in classes])))


def data_dictionary(df: DataFrame, order_col: str, approximate: bool = False) -> DataFrame:
    """Per column: type, non-NULL count, distinct count, first non-NULL value.

    Non-NULL counts and the first value in table order (``min_by`` over the order
    key, NULLs skipped) come from one global aggregate over the table as it is -
    no grouping key, so no sort and one partial row per task. The exact distinct
    counts unpivot the table once into (column, value-as-text) and reduce it with
    a hash aggregate on the pairs, instead of one expanded copy of every row per
    ``count(distinct)``; values of any length are compared as they are.
    ``approximate=True`` puts HyperLogLog++ counts into the global aggregate and skips
    the unpivot, the caller's choice where long distinct texts make the shuffle too dear.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = df.columns
    o = F.col(order_col)
    fields = []
    for i, c in enumerate(cols):
        parts = [F.lit(c).alias("column_name"), F.lit(types[c]).alias("dtype"),
                 F.lit(i).alias("__pos"), F.count(c).alias("n_nonnull"),
                 F.min_by(F.col(c).cast("string"), F.when(F.col(c).isNotNull(), o)).alias("example")]
        if approximate:
            parts.append(F.approx_count_distinct(c).alias("n_unique"))
        fields.append(F.struct(*parts).alias(f"__c{i}"))
    info = df.agg(*fields).select(F.inline(F.array(*[F.col(f"__c{i}") for i in range(len(cols))])))
    if not approximate:
        long = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols
        ]))).where(F.col("v").isNotNull())
        uniq = (long.select("column_name", "v").distinct()
                    .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique")))
        info = info.join(uniq, "column_name", "left")
    return info.orderBy("__pos").select(
        "column_name", "dtype",
        F.col("n_nonnull").cast("bigint").alias("n_nonnull"),
        F.coalesce("n_unique", F.lit(0)).cast("bigint").alias("n_unique"),
        F.coalesce("example", F.lit("")).alias("example"))


#: log2 of the registers of a distinct-count sketch, and the standard error of its estimate.
SKETCH_BITS = 12
DISTINCT_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
#: Size of a quantile sketch: a median from it has a rank within RANK_ERROR of the half, with 99 % confidence.
QUANTILE_K = 400
RANK_ERROR = 0.01


def profile_sketches(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A profile that merges: per column counts, a distinct-count sketch and, of numbers, a quantile sketch.

    One global aggregate without a row per value, one row per column; its size does not grow with the rows, so
    the rows of each extract can be stored and those of many extracts merged later (``merge_profiles``) without
    reading the extracts again. NaN is left out of the quantiles; a column without values has empty sketches.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = []
    for i, c in enumerate(cols or df.columns):
        x = F.col("`" + c.replace("`", "``") + "`")
        number = F.when(~F.isnan(x.cast("double")), x.cast("double")) if is_numeric(types[c]) else F.lit(None).cast("double")
        fields.append(F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("pos"), F.count(F.lit(1)).alias("n"),
                               F.count(x).alias("n_nonnull"), F.hll_sketch_agg(x.cast("string"), F.lit(SKETCH_BITS)).alias("distinct_sketch"),
                               F.kll_sketch_agg_double(number, F.lit(QUANTILE_K)).alias("quantile_sketch")).alias(f"__c{i}"))
    return df.agg(*fields).select(F.inline(F.array(*[F.col(f"__c{i}") for i in range(len(fields))])))


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """One profile of several (rows of ``profile_sketches``, stacked); a column that only some have counts there."""
    return profiles.groupBy("column_name").agg(
        F.min("pos").alias("pos"), F.sum("n").alias("n"), F.sum("n_nonnull").alias("n_nonnull"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def read_profile(profiles: DataFrame) -> DataFrame:
    """Counts, estimated distinct values (standard error ``DISTINCT_ERROR``) and median (rank error ``RANK_ERROR``)."""
    some = F.kll_sketch_get_n_double("quantile_sketch") > 0
    return profiles.select("column_name", "pos", "n", "n_nonnull", F.hll_sketch_estimate("distinct_sketch").alias("n_unique"),
                           F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(0.5))).alias("median"))


def top_categories(df: DataFrame, col: str, n: int, by: list[str] | None = None,
                   total: int | None = None) -> DataFrame:
    """Top-n values of ``col`` (NULLs excluded) with their share of all rows.

    Ties: count desc, then value asc. With ``by``, top-n per group in two window
    steps over the value counts, never over raw rows: counts are salted by a hash
    of the value into ``shuffle.partitions`` sub-groups, each keeps its own top-n,
    and only those survivors (at most ``n x salts`` rows per group) are ranked per
    group. Exact, because a group's top-n values are each in their sub-group's
    top-n; and a hot group's vocabulary is sorted across many tasks, not one.
    """
    by = list(by or [])
    counts = (df.where(F.col(col).isNotNull())
                .groupBy(*by, col).agg(F.count(F.lit(1)).alias("n")))
    totals = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__total")) if by else None
    w = Window.partitionBy(*by).orderBy(F.desc("n"), F.asc(col)) if by else \
        Window.orderBy(F.desc("n"), F.asc(col))
    if by:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = counts.withColumn("__s", F.pmod(F.xxhash64(F.col(col)), F.lit(salts)))
        w_s = Window.partitionBy(*by, "__s").orderBy(F.desc("n"), F.asc(col))
        local = (salted.withColumn("__r", F.row_number().over(w_s))
                       .where(F.col("__r") <= n).drop("__s", "__r"))
        ranked = local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
        ranked = join_groups(ranked, totals, by)
    else:
        # global top-n: TakeOrderedAndProject keeps n rows per task, no full sort;
        # the denominator is one number, passed as a literal
        total = df.count() if total is None else total
        top = counts.orderBy(F.desc("n"), F.asc(col)).limit(n)
        ranked = (top.withColumn("rank", F.row_number().over(w))
                     .withColumn("__total", F.lit(total)))
    return ranked.select(*by, F.col("rank").cast("int").alias("rank"), F.col(col).alias("value"),
                         "n", F.round(F.col("n") / F.col("__total"), 6).alias("share"))


def mode(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Most frequent non-NULL value per group (E4), ties -> smallest value."""
    if by:
        from .clusters import group_mode
        return group_mode(df, by, col)
    return top_categories(df, col, 1).drop("rank")


def flag_prevalence(df: DataFrame, flags: list[str], descriptions: dict[str, str],
                    label: str = "severe") -> DataFrame:
    """Per flag: overall / label=1 / label=0 prevalence in percent, one decimal.

    One aggregate by label holds a sum and a count per flag; the three shares come
    from its few rows, unpivoted, and are rounded as columns of one row per flag (the rounding repeats
    its argument, which must be cheap); sorted by overall prevalence.
    """
    per = df.groupBy(label).agg(*[F.sum(F.col(c).cast("double")).alias(f"__s_{c}") for c in flags],
                                *[F.count(c).alias(f"__n_{c}") for c in flags])

    def share(c, of=None):
        s, n = (F.sum(x if of is None else F.when(F.col(label) == of, x)) for x in (F.col(f"__s_{c}"), F.col(f"__n_{c}")))
        return F.when(n > 0, s / n) * 100.0
    row = per.agg(*[F.struct(F.lit(c).alias("feature"), F.lit(descriptions.get(c, "")).alias("description"),
                             share(c).alias("overall_pct"), share(c, 1).alias("severe_pct"),
                             share(c, 0).alias("nonsevere_pct")).alias(f"__{c}") for c in flags])
    shares = row.select(F.inline(F.array(*[F.col(f"__{c}") for c in flags])))
    return (shares.select("feature", "description", *[round1(c).alias(c) for c in ("overall_pct", "severe_pct", "nonsevere_pct")])
               .orderBy(F.desc("overall_pct"), F.asc("feature")))
