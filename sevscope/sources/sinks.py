"""Sinks for the cleaned table and result tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_cleaned(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by=("era", "automation_level")) -> None:
    """Cleaned incidents as parquet partitioned by era and level (A5).

    Later filters on era / level (splits, per-level models) prune whole
    directories; ``severity_known`` filters are pushed into the row-group scan.
    """
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_cleaned(spark: SparkSession, path: str, known_only: bool = False) -> DataFrame:
    """Reload the cleaned table; ``known_only`` applies the labelled-subset filter."""
    df = spark.read.parquet(path)
    return df.where(F.col("severity_known") == 1) if known_only else df


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Result tables (metrics, coefficients, misses, cluster summaries)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
