"""Folder listing and marker files on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def folders(spark: SparkSession, base: str, pattern: str = "*") -> dict[str, str]:
    """Folder name to full path for the folders under ``base`` that match a glob, sorted."""
    fs, at = _at(spark, f"{base.rstrip('/')}/{pattern}")
    found = fs.globStatus(at) or []
    return dict(sorted((s.getPath().getName(), s.getPath().toString()) for s in found if s.isDirectory()))


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder with all it holds; whether there was one."""
    fs, at = _at(spark, path)
    return fs.delete(at, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty folder: made in one step, there or not."""
    fs, at = _at(spark, path)
    if not fs.mkdirs(at):
        raise OSError(f"cannot make {path}")
