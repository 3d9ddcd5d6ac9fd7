"""Session construction and lineage cutting."""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

DEFAULT_LOCAL_CHECKPOINT_DIR = "/tmp/sevscope-checkpoints"


def get_spark(master: str | None = None, app: str = "sevscope",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build one with sane analytics defaults.

    On a cluster the session is normally created by the launcher; this helper
    only fills in settings that are unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a local one only if unset (tests).

    ``spark.checkpoint.dir`` is a core setting that a running session may not change,
    so an unset folder is set on the SparkContext (``setCheckpointDir``) instead.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not (getattr(sc, "master", None) or "local").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that the driver and all executors share")
        d = os.environ.get("SEVSCOPE_CHECKPOINT_DIR", DEFAULT_LOCAL_CHECKPOINT_DIR)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def side_by_side(fn: Callable, items, most: int = 4) -> list:
    """``fn`` of each item in order, up to ``most`` at once: their Spark jobs share the cores, so jobs of few tasks leave none idle."""
    items = list(items)
    with ThreadPoolExecutor(max_workers=max(1, min(most, len(items)))) as pool:
        return list(pool.map(fn, items))


def drop_stages(spark: SparkSession) -> None:
    """Delete the stage tables of this application."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages/{spark.sparkContext.applicationId}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def cut_lineage(df: DataFrame, name: str = "lineage") -> DataFrame:
    """Cut ``df``'s lineage with a table written to the shared checkpoint folder.

    Used before driver-side loops over one table (model grids, k search) so a
    lost executor re-reads the written files instead of recomputing the whole
    plan. A parquet stage table (``write_stage``) rather than an RDD checkpoint:
    the plan runs once (a reliable RDD checkpoint of an unpersisted frame runs
    it twice, once for the action and once to save it), and the read-back is
    columnar, so later scans prune columns.
    """
    return write_stage(df, name)


def write_stage(df: DataFrame, name: str, partition_by=(), mode: str = "overwrite") -> DataFrame:
    """Materialise ``df`` as a parquet table under the shared checkpoint folder and
    read it back with the same schema. Unlike an RDD checkpoint the result keeps
    column pruning, predicate pushdown and (with ``partition_by``) directory pruning."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # one folder per application, so a finished application's stages expire as a unit
    app = spark.sparkContext.applicationId
    path = f"{base}/stages/{app}/{name}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
