"""Integrity checks that a lake does not enforce: each returns the violations as a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_layers.operators.columns import quoted


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return (
        df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def orphans(child: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Foreign keys (no part NULL) without a parent, with the number of child rows.

    The child is counted per key before the join, so a key that many rows share
    travels as one row. An anti join would undo that: the optimizer moves it below the
    aggregation. An outer join that keeps what found no partner stays above it.
    """
    held = (
        child.dropna(subset=list(fk))
        .groupBy(*map(quoted, fk)).agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(*[quoted(p).alias(f) for p, f in zip(pk, fk, strict=True)],
                          F.lit(True).alias("_known"))
    return held.join(known, list(fk), "left").where(F.col("_known").isNull()).drop("_known")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column with its number of NULLs, from a single pass over ``df``."""
    totals = df.agg(*[F.count_if(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_rows"))
        for i, c in enumerate(cols)
    ])
    return totals.select(F.inline(rows))
