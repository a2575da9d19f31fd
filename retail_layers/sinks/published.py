"""Runs written beside each other and put in force by one small switch.

A folder sink with ``"publish": True`` holds ``run=<n>`` folders, one per run, and
``published/<n>`` markers. A run writes its tables under its own folder; only when all of
them are complete is the marker set, and readers take the tables of the last marked run.
A run that fails leaves what was published before as it was. One run at a time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from retail_layers.sources import paths


def is_published(sink: Mapping) -> bool:
    if not sink.get("publish", False):
        return False
    if "base_path" not in sink or "catalog_db" in sink:
        raise ValueError("only a folder sink can be published by a switch")
    return True


def staged(spark: SparkSession, sink: Mapping) -> dict:
    """The sink of a new run: a folder no reader follows yet, after all that exist."""
    base = sink["base_path"].rstrip("/")
    number = max([*_numbers(spark, base, "run="), *_numbers(spark, f"{base}/published")], default=0) + 1
    return {**sink, "base_path": f"{base}/run={number}"}


def publish(spark: SparkSession, sink: Mapping, run: Mapping) -> int:
    """Put a staged run in force; its number."""
    number = int(run["base_path"].rsplit("run=", 1)[1])
    paths.mark(spark, f"{sink['base_path'].rstrip('/')}/published/{number}")
    return number


def in_force(spark: SparkSession, sink: Mapping) -> dict:
    """The sink as readers see it: the folder of the last published run."""
    if not is_published(sink):
        return dict(sink)
    base = sink["base_path"].rstrip("/")
    numbers = _numbers(spark, f"{base}/published")
    if not numbers:
        raise ValueError(f"no published run under {base}")
    return {**sink, "base_path": f"{base}/run={numbers[-1]}"}


def discard(spark: SparkSession, sink: Mapping, runs: int = 1) -> int:
    """Remove all but the last ``runs`` published runs, failed ones included; how many folders went.

    Not to be called beside a run, or while an older run is being read.
    """
    if runs < 1:
        raise ValueError("the last run has to stay")
    base = sink["base_path"].rstrip("/")
    numbers = _numbers(spark, f"{base}/published")
    if not numbers:
        return 0
    kept = numbers[-runs:]
    for n in numbers[:-runs]:
        paths.remove(spark, f"{base}/published/{n}")
    return sum(paths.remove(spark, f"{base}/run={n}") for n in _numbers(spark, base, "run=") if n not in kept)


def _numbers(spark: SparkSession, base: str, mark: str = "") -> list[int]:
    found = [name.removeprefix(mark) for name in paths.folders(spark, base, f"{mark}*")]
    return sorted(int(name) for name in found if name.isdigit())
