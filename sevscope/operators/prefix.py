"""Ordered selection and ordered pairs by radix slices.

Exact medians (C9/F20) and rank-based ROC AUC (E3) need "how much comes before this value". A
window ordered over a whole group would move the group into one task, and a group here can be a
third of the table. Instead every double gets a long in the same order (``ordered_code``), and the
code is read ``SLICE_BITS`` at a time as a tree: a node has at most 2^16 children, so no window
sorts more than 65,536 rows however many rows or distinct values a group has.

* ``ordered_pairs`` (AUC) goes up the tree. Two values part at exactly one node, so the pairs in
  order are the sum over all nodes of (what a child has) x (what its earlier siblings have). Each
  level is one window and one sum; no join, no broadcast, no cap.
* ``medians`` goes down the tree: sums per slice, the slice that holds the rank, then only its rows.

Both are lazy plans, exact, and do not depend on partitioning or task retries.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .groups import join_groups

CODE_BITS = 64
SLICE_BITS = 16
#: Codes of what has no bits of its own: NULL before all numbers, NaN after them (Spark's order).
_INFINITE = 2047 << 52
_NULL, _NAN = -(1 << 63), _INFINITE + 1


def ordered_code(value) -> Column:
    """A long that sorts as the double ``value`` does and differs where it differs (-0.0 is 0.0).

    Exponent and mantissa are read from the exact hexadecimal form ``0x1.<digits>p<exponent>``
    (``0x0.`` below the normal numbers), so the code is native and without rounding.
    """
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    form = F.format_string("%a", F.abs(x))
    body = F.substring_index(form, "p", 1)
    mantissa = F.conv(F.rpad(F.substring_index(body, ".", -1), 13, "0"), 16, 10).try_cast("long")
    exponent = F.when(body.startswith("0x1."), F.substring_index(form, "p", -1).try_cast("long") + 1023).otherwise(F.lit(0))
    bits = F.when(F.abs(x) == float("inf"), F.lit(_INFINITE)).otherwise(F.shiftleft(exponent, 52) + mantissa)
    return (F.when(x.isNull(), F.lit(_NULL)).when(F.isnan(x), F.lit(_NAN))
             .when(x < 0, -bits).otherwise(bits))


def ordered_pairs(hist: DataFrame, keys: list[str], value: str, upper: str, lower: str,
                  carry: list[str] | None = None, bits: int = SLICE_BITS) -> DataFrame:
    """One row per ``keys`` group of ``hist`` (one row per group and distinct ``value``): the sums of
    ``upper``, ``lower`` and ``carry``, and ``pairs``: how many (upper, lower) pairs have the lower
    one's value strictly smaller, and half of those with equal values. NULL keys are a group."""
    keys = list(keys)
    sums = [upper, lower, *(carry or [])]
    levels = -(-CODE_BITS // bits)
    rows = hist.select(*keys, ordered_code(value).alias("__node"), *sums,
                       (F.col(upper).cast("double") * F.col(lower) / 2.0).alias("pairs"))
    for level in range(levels):
        top = level == levels - 1
        rows = rows.withColumn("__parent", F.lit(0) if top else F.shiftright("__node", bits))
        siblings = (Window.partitionBy(*keys, "__parent").orderBy("__node")
                    .rowsBetween(Window.unboundedPreceding, -1))
        rows = rows.withColumn("__before", F.coalesce(F.sum(lower).over(siblings), F.lit(0)))
        met = F.sum(F.col("pairs") + F.col(upper).cast("double") * F.col("__before")).alias("pairs")
        rows = rows.groupBy(*keys, *([] if top else ["__parent"])).agg(*[F.sum(c).alias(c) for c in sums], met)
        if not top:
            rows = rows.withColumnRenamed("__parent", "__node")
    return rows


def medians(df: DataFrame, cols: list[str], bits: int = SLICE_BITS) -> DataFrame:
    """(col, median) of each column with a value (NULL and NaN skipped; mean of the two middle
    values for even counts). Values are counted once; the levels read the counts' one exchange."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("x")).select("x.col", "x.v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = long.groupBy("col", "v").agg(F.count(F.lit(1)).alias("cnt"))
    sums = [F.sum("cnt").alias("cnt"), F.min("v").alias("least"), F.max("v").alias("most")]
    levels = -(-CODE_BITS // bits)
    for level in range(levels):
        # later levels take the chosen slices' values alone, so a code is computed once for most values
        rows = join_groups(counts, F.broadcast(at), ["col"]).where(F.col("v").between(F.col("from"), F.col("to"))) if level else counts
        of = ["col", "half", "rank"] if level else ["col"]
        node = F.shiftright(ordered_code("v"), bits * (levels - 1 - level)).alias("node")
        siblings = Window.partitionBy(*of).orderBy("node")
        nodes = (rows.groupBy(*of, node).agg(*sums)
                 .withColumn("before", F.coalesce(F.sum("cnt").over(siblings.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
        if not level:
            # 0-based middle ranks
            n = F.sum("cnt").over(Window.partitionBy("col"))
            nodes = (nodes.withColumn("middle", F.array(F.floor((n - 1) / 2), F.floor(n / 2)))
                     .select("*", F.posexplode("middle").alias("half", "rank")))
        # two rows a column, so the next level's broadcast is small
        at = (nodes.where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("cnt")))
              .select("col", "half", (F.col("rank") - F.col("before")).alias("rank"),
                      F.col("least").alias("from"), F.col("most").alias("to")))
    return at.groupBy("col").agg(((F.min("from") + F.max("to")) / 2.0).alias("median"))


def exact_medians(df: DataFrame, cols: list[str], bits: int = SLICE_BITS) -> dict[str, float | None]:
    """``medians`` as numbers (all-NULL: None): one row per column reaches the driver."""
    if not cols:
        return {}
    out: dict[str, float | None] = {c: None for c in cols}
    out |= {r["col"]: r["median"] for r in medians(df, cols, bits).collect()}
    return out
