"""One row per incident.

Per incident key: numeric columns -> max (NULLs skipped); every other column ->
its first non-NULL value in report-id order (missing ids last).

``min_by(c, ord)`` skips rows whose ordering is NULL, so the ordering is made
NULL exactly where ``c`` is NULL: the result is the value of the lowest report id
that has one. This is deterministic (``first(ignorenulls)`` is not) and, being an
aggregate, is combined map-side before the shuffle on the incident key. Its partial
rows repeat the report id for every column, so with ``gather`` (as in ``latest_version``,
where no key is hot) the reports move as they are and are combined behind the shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import is_numeric


def consolidate(df: DataFrame, key_col: str = "incident_key",
                order_col: str = "report_id", gather: bool = False) -> DataFrame:
    if gather:
        df = df.repartition(F.col(key_col))
    types = {f.name: f.dataType for f in df.schema.fields}
    o = F.col(order_col)
    order_key = F.struct(o.isNull().alias("m"), o.alias("v"))
    aggs = []
    for c in df.columns:
        if c == key_col:
            continue
        if is_numeric(types[c]):
            aggs.append(F.max(c).alias(c))
        else:
            aggs.append(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order_key)).alias(c))
    return df.groupBy(key_col).agg(*aggs)
