"""Missingness indicators and imputation.

The column lists are decided from one aggregate of NULL counts (one row to the
driver); the fill values are literals, so the rewrite itself is a narrow
projection with no join and no shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .prefix import exact_medians


def null_counts(df: DataFrame, cols: list[str]) -> dict[str, int]:
    if not cols:
        return {}
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def indicator_candidates(df: DataFrame, skip=S.SKIP_INDICATOR) -> list[str]:
    return [c for c in df.columns if c not in set(skip) and not c.endswith(S.MISSING_SUFFIX)]


def add_missing_indicators(df: DataFrame, cols: list[str] | None = None,
                           skip=S.SKIP_INDICATOR) -> tuple[DataFrame, list[str]]:
    """Add ``<col>__is_missing`` (int 0/1) for every non-skipped column with >= 1 NULL."""
    cand = cols if cols is not None else indicator_candidates(df, skip)
    counts = null_counts(df, cand)
    with_missing = [c for c in cand if counts[c] > 0]
    out = df.withColumns({f"{c}{S.MISSING_SUFFIX}": F.col(c).isNull().cast("int")
                          for c in with_missing})
    return out, with_missing


def missing_and_impute(df: DataFrame, skip=S.SKIP_INDICATOR) -> tuple[DataFrame, list[str], dict]:
    """Indicators then imputation, sharing one NULL-count pass."""
    cand = indicator_candidates(df, skip)
    counts = null_counts(df, cand)
    out, ind = add_missing_indicators(df, [c for c in cand if counts[c] > 0])
    out, fills = impute(out, skip, counts={**counts, **{f"{c}{S.MISSING_SUFFIX}": 0 for c in ind}})
    return out, ind, fills


def impute(df: DataFrame, skip=S.SKIP_INDICATOR, medians: dict | None = None,
           median_source: DataFrame | None = None,
           counts: dict | None = None) -> tuple[DataFrame, dict]:
    """Numeric columns with NULLs -> exact median; other columns -> 'Unknown'.

    ``median_source`` lets a caller fit the medians on another frame (e.g. train
    only); by default they come from ``df`` itself, as in the reference.
    Returns the frame and the fill values used.
    """
    cand = indicator_candidates(df, skip)
    counts = counts if counts is not None else null_counts(df, cand)
    todo = [c for c in cand if counts[c] > 0]
    num = S.numeric_columns(df.schema, todo)
    cat = [c for c in todo if c not in num]
    if medians is None:
        medians = exact_medians(median_source if median_source is not None else df, num)
    fills = {}
    for c in num:
        if medians.get(c) is not None:
            # a numeric column with NULLs is float in the reference, so fill as double
            fills[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(medians[c])))
    for c in cat:
        fills[c] = F.coalesce(F.col(c), F.lit(S.UNKNOWN_CATEGORY))
    used = {**{c: medians.get(c) for c in num}, **{c: S.UNKNOWN_CATEGORY for c in cat}}
    return df.withColumns(fills), used
