"""Latest report version per report id.

Semantics: sort by (id, version) ascending with missing versions last and keep
the last row per id -> a missing version wins, then the highest version; equal
versions are resolved by the caller's tie-break columns (source order, then row
content), all descending. All NULL ids form one key.

Plan: ``groupBy(id).agg(max(struct(order..., payload...)))``. Unlike a
``row_number`` window this is an aggregate, so Spark runs a partial (map-side)
max before the shuffle: a hot id - even one holding a third of all rows, as the
NULL id can - is reduced to one row per input partition before it moves. That
max sorts (and spills) each map task's rows, which gains nothing where ids hardly
repeat: with ``gather`` the rows go to their id's task as they are and are reduced
there alone. Callers ask for it when no id is hot (``groups.hot_keys``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_version(df: DataFrame, id_col: str = "report_id",
                   version_col: str = "report_version",
                   tiebreak_cols: list[str] | None = None,
                   keep_tiebreak: bool = False, gather: bool = False) -> DataFrame:
    if gather:
        df = df.repartition(F.col(id_col))
    tiebreak_cols = list(tiebreak_cols or [])
    payload = [c for c in df.columns if c != id_col]
    v = F.col(version_col)
    order = [v.isNull().alias("__v_missing"),
             F.coalesce(v, F.lit(0.0)).alias("__v")]
    order += [F.col(c).alias(f"__t{i}") for i, c in enumerate(tiebreak_cols)]
    best = F.max(F.struct(*order, F.struct(*[F.col(c) for c in payload]).alias("row")))
    out = (df.groupBy(id_col).agg(best.alias("__best"))
             .select(id_col, *[F.col(f"__best.row.{c}").alias(c) for c in payload]))
    if not keep_tiebreak:
        out = out.drop(*[c for c in tiebreak_cols if c != id_col])
    return out.select(*[c for c in df.columns if c in out.columns])
