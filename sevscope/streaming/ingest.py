"""Incremental ingestion of newly dropped report extracts (Structured Streaming).

The reference is batch-only. Extract drops arrive as whole CSV files, so the
stream is a file source with an ``availableNow`` trigger: each run picks up only
files not seen before (tracked in the checkpoint), applies the same scan rules as
the batch source (missing tokens, declared types, provenance) and appends the raw
report versions to a parquet table. The batch cleaning job then re-derives the
latest versions from that table.
"""
from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..sources import extracts as X


def ingest_extract_drops(spark: SparkSession, drop_dir: str, raw_columns: list[str],
                         level: str, era: str, out_path: str, checkpoint: str,
                         encoding: str = "UTF-8"):
    """Append every new CSV file in ``drop_dir`` to ``out_path``; returns the finished query."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in raw_columns])
    stream = (spark.readStream.schema(schema)
              .option("header", True).option("encoding", encoding)
              .option("multiLine", True).option("escape", '"')
              .csv(drop_dir))
    df = X.normalise_missing(stream)
    if era == "archived":
        df = X.harmonise(df, S.ARCHIVED_RENAME)
    df = X.tag_provenance(df, level, era).withColumn("ingest_file", F.input_file_name())
    df = X.apply_declared_types(X.to_internal_names(df), dict(S.NUMERIC_RAW))
    q = (df.writeStream.format("parquet").option("path", out_path)
           .option("checkpointLocation", checkpoint).outputMode("append")
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
