"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 4; fold 2 is held out. A missing id is in no fold."""
    return F.crc32(F.col(doc_id).cast("string")) % 4


def held_out(doc_id: str) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps whose results were kept.

    Spark's cleaner acts when the driver's JVM collects garbage, which on a quiet driver
    may be long after the files were last needed.
    """
    spark.sparkContext._jvm.System.gc()


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``.

    Spark sends thousands of texts at a time; turning a few of them into Python objects at
    once keeps a worker's memory near the batch itself.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
