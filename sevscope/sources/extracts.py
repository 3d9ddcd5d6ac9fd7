"""Raw report extracts: CSV scan, missing tokens, declared types, provenance (A1-A4, B1-B2).

A real deployment points ``read_extracts`` at the versioned CSV drops; each file
carries its own encoding and provenance (automation level, era). Everything is
read as text first, then cast with ``try_cast`` (bad text -> NULL instead of an
ANSI error), so declared types never depend on which values happen to be present. Columns
that the declaration does not name are numbers if all their values are (``infer_numeric``).
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..session import side_by_side
from . import records as R


@dataclass(frozen=True)
class Extract:
    path: str
    encoding: str
    automation_level: str
    era: str
    # quoted fields may hold newlines; False for extracts known to be newline-free
    # saves the search for the records' ends in files of several splits.
    multi_line: bool = True


def split_bytes(spark: SparkSession) -> int:
    """``spark.sql.files.maxPartitionBytes`` as a number."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file at ``path``, from the listing alone."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


def read_csv_text(spark: SparkSession, path: str, encoding: str = "UTF-8",
                  multi_line: bool = True, split: bool | None = None) -> DataFrame:
    """All columns as strings; quoted fields may contain newlines (A1).

    Spark's ``multiLine`` parser takes a file in one task. With ``split``, many tasks read each file
    (``records.record_texts``) with the same rows; unset, files larger than one input split are so read.
    Encodings in which quotes and newlines are not single ASCII bytes stay with the ``multiLine`` parser.
    """
    whole = (spark.read
             .option("header", True)
             .option("encoding", encoding)
             .option("multiLine", multi_line)
             .option("escape", '"')
             .option("inferSchema", False)
             .option("nullValue", None)
             .option("emptyValue", "")
             .csv(path))
    splittable = multi_line and encoding.lower() in R.SPLIT_ENCODINGS and bool(whole.columns)
    if split is None:
        split = splittable and largest_file(spark, path) > split_bytes(spark)
    if not (split and splittable):
        return whole
    return R.parse_records(R.record_texts(spark, path, encoding), whole.columns)


def named(col: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + col.replace("`", "``") + "`")


def normalise_missing(df: DataFrame, tokens=S.NA_TOKENS) -> DataFrame:
    """Map the CSV missing-value tokens to NULL in every string column (A2).

    Matching is exact (no trimming), like a CSV reader's token list.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    fixes = {c: F.when(named(c).isin(*tokens), F.lit(None).cast("string")).otherwise(named(c))
             for c in df.columns if isinstance(types[c], T.StringType)}
    return df.withColumns(fixes)


def apply_declared_types(df: DataFrame, declared: dict[str, T.DataType]) -> DataFrame:
    """Cast listed columns with ``try_cast``: unparsable text -> NULL."""
    casts = {c: named(c).try_cast(t) for c, t in declared.items() if c in df.columns}
    return df.withColumns(casts)


#: A decimal number as a CSV reader takes it.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def infer_numeric(df: DataFrame, cols: list[str]) -> dict[str, T.DataType]:
    """Those of the string columns ``cols`` whose values, NULLs aside, are all numbers, as doubles (A3).

    One aggregate over all rows, with one row for the driver; a column without any value stays text.
    """
    if not cols:
        return {}
    seen = df.agg(*[F.struct(F.count(named(c)).alias("n"), F.count_if(named(c).rlike(NUMBER)).alias("numbers")).alias(f"c{i}")
                    for i, c in enumerate(cols)]).first()
    return {c: T.DoubleType() for c, x in zip(cols, seen) if x["n"] and x["n"] == x["numbers"]}


def tag_provenance(df: DataFrame, level: str, era: str) -> DataFrame:
    """automation_level / era literals (A4)."""
    return df.withColumns({"automation_level": F.lit(level), "era": F.lit(era)})


def harmonise(df: DataFrame, rename: dict[str, str]) -> DataFrame:
    """Rename old -> new; when both exist, keep new and fill its NULLs from old (B1).

    A Spark frame cannot hold two columns of one name, so the clash case merges.
    """
    for old, new in rename.items():
        if old not in df.columns:
            continue
        if new in df.columns:
            df = df.withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old)
        else:
            df = df.withColumnRenamed(old, new)
    return df


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Stack extracts; columns missing from one side become NULL (B2)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def to_internal_names(df: DataFrame) -> DataFrame:
    mapping = {k: v for k, v in S.RAW_TO_INTERNAL.items() if k in df.columns}
    return df.withColumnsRenamed(mapping)


def read_extracts(spark: SparkSession, extracts: list[Extract], infer: bool = True) -> DataFrame:
    """Full scan stage: per-file read -> tokens -> rename -> union -> types.

    Adds ``source_ord`` (position of the extract in the list) so "latest version"
    can break equal-version ties by source order, and keeps the file's own row
    order only through deterministic tie-break columns supplied by the caller.
    With ``infer``, columns outside the declared schema take their type from all their
    values, in one more pass that extracts of declared columns alone do without.
    """
    frames = []
    # large files are cut into records here, by jobs of their own
    texts = side_by_side(lambda ex: read_csv_text(spark, ex.path, ex.encoding, ex.multi_line), extracts)
    for i, (ex, text) in enumerate(zip(extracts, texts)):
        df = normalise_missing(text)
        if ex.era == "archived":
            df = harmonise(df, S.ARCHIVED_RENAME)
        df = tag_provenance(df, ex.automation_level, ex.era).withColumn("source_ord", F.lit(i))
        frames.append(df)
    out = to_internal_names(union_by_name(frames))
    known = {*S.report_schema().names, "source_ord"}
    found = infer_numeric(out, [c for c in out.columns if c not in known]) if infer else {}
    return apply_declared_types(out, {**found, **S.NUMERIC_RAW})
