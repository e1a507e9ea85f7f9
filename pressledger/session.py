"""Session settings and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Python workers receive bounded Arrow batches however wide the rows are
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def build_session(app: str = "pressledger", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def pinned_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting a cluster is refused, as its executors would write to their own disks. A session of one machine
    (``local``) gets a temporary folder, which all of it sees.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="pressledger-checkpoint-"))
    return context.getCheckpointDir()


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` to a Parquet table in the shared checkpoint folder and read it back.

    This cuts lineage, survives lost executors, computes ``df`` once, and lets later readers prune columns and plan joins
    by the real size.
    """
    path = f"{pinned_folder(df.sparkSession)}/pinned-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
