"""Group keys: joins in which NULL is a group like any other, and keys that hold many rows."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slices of the hashed keys that are counted; a slice is hot beyond ``HOT_ROWS`` rows and ``HOT_TIMES`` the mean.
KEY_SLICES, HOT_ROWS, HOT_TIMES = 1 << 16, 250_000, 8


def hot_keys(df: DataFrame, *keys: Column) -> list[bool]:
    """For each of ``keys``: whether one value of it may hold more rows than one task should take.

    One hash aggregate of at most ``KEY_SLICES`` counts a key; one row a key reaches the driver. Rows
    that ``df`` loses later only lower the counts, so the answer for raw rows holds for what is left of them.
    """
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("key"), F.pmod(F.xxhash64(k), F.lit(KEY_SLICES)).alias("slice"))
                                         for i, k in enumerate(keys)])))
    counts = pairs.groupBy("key", "slice").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("key").agg(F.max("n").alias("most"), F.sum("n").alias("all")).collect()
    hot = {r["key"] for r in found if r["most"] > max(HOT_ROWS, HOT_TIMES * r["all"] / KEY_SLICES)}
    return [i in hot for i in range(len(keys))]


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on null-safe equal ``keys``; the keys appear once, from ``left``."""
    other = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (left[k].eqNullSafe(other[f"__right_{k}"]) for k in keys))
    return left.join(other, same, how).drop(*(f"__right_{k}" for k in keys))
