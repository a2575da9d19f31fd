"""Shared storage for results that have to be fixed before they are used twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, made once per
    session; on a cluster a machine's own disk is not shared, so there the setting is
    required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="retail-layers-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """``df`` as a table in shared storage: one fixed result, with its lineage cut.

    Parquet rather than a checkpoint, because readers then scan only the columns they
    need, compressed, and Spark knows the size.
    """
    path = scratch_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
