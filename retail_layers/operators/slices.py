"""Cutting large groups into slices that follow the group's order.

A slice is a path of positions between cut points: one position per time the group was cut.
Cut points come from quantile sketches over narrow columns; wide rows are never dealt by range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_layers.operators.columns import quoted
from retail_layers.operators.skew import if_small, matches
from retail_layers.scratch import keep

CUTS = 64  # slices one cut makes of a group at most; slices still too large are cut again
STRIDE = 8
ACCURACY = 10_000
FIRST = -(1 << 63)  # where missing values stand: before all others


def order_number(df: DataFrame, col: str) -> Column | None:
    """A whole number that never falls along ``col``, or None for types without one."""
    kind, c = df.schema[col].dataType, quoted(col)
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_date(c.cast("date")).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    return None


def _position(value: Column) -> Column:
    """How many cuts lie before ``value``; a heavy point is also cut off from what is before it.

    Every ``STRIDE``th point is looked at first, then those between two of them.
    """
    passed = STRIDE * F.size(F.filter("_coarse", lambda p: p < value))
    near = F.size(F.filter(F.slice("_points", passed + 1, F.lit(STRIDE)), lambda p: p < value))
    return passed + near + F.size(F.filter("_heavy", lambda p: p <= value))


def mark(df: DataFrame, keys: Sequence[str], numbers: Sequence[Column], cuts: Sequence[DataFrame]) -> DataFrame:
    """``df`` with ``_slice``, an empty path for rows of groups that were not cut."""
    taken = df.columns
    df = df.withColumn("_slice", F.array().cast("array<int>"))
    for level in cuts:
        same = matches(df, keys, level) & (df["_slice"] == level["_path"])
        values = F.array(*[F.coalesce(n, F.lit(FIRST)) for n in numbers])
        df = df.join(level, same, "left").select(
            *[quoted(c) for c in taken],
            F.when(F.col("_points").isNotNull(), F.concat("_slice", F.array(_position(F.get(values, F.col("_which"))))))
            .otherwise(F.col("_slice")).alias("_slice"))
    return df


def _sketched(marked: DataFrame, keys: Sequence[str], numbers: Sequence[Column], over: DataFrame) -> DataFrame:
    """Cut points of the slices in ``over`` (key, _path, _which, _wanted)."""
    over = if_small(over)
    found = marked.join(over, matches(marked, keys, over) & (marked["_slice"] == over["_path"]))
    value = F.get(F.array(*[F.coalesce(n, F.lit(FIRST)) for n in numbers]), F.col("_which"))
    names = [c for c in over.columns if c.startswith("_key_")]
    sketch = found.select(*names, "_path", "_which", "_wanted", value.alias("_value")).groupBy(*names, "_path", "_which", "_wanted").agg(
        F.percentile_approx("_value", [k / CUTS for k in range(1, CUTS)], ACCURACY).alias("_q"))
    picked = F.transform(F.sequence(F.lit(1), F.col("_wanted") - 1), lambda j: F.element_at("_q", (j * CUTS / F.col("_wanted")).cast("int")))
    # a value is heavy that fills a slice by itself
    share = F.greatest(F.lit(2), F.floor(F.lit(CUTS) / F.col("_wanted")) - 1)
    heavy = F.filter(F.array_distinct("_all"), lambda p: F.size(F.filter("_q", lambda x: x == p)) >= share)
    coarse = F.filter("_points", lambda p, i: (i + 1) % STRIDE == 0)
    return keep(
        sketch.withColumn("_all", picked).withColumn("_points", F.array_distinct("_all"))
        .select(*names, "_path", "_which", "_points", coarse.alias("_coarse"), heavy.alias("_heavy")))


def cut_groups(df: DataFrame, keys: Sequence[str], numbers: Sequence[Column], large: DataFrame, rows: int) -> tuple[list[DataFrame], DataFrame]:
    """The cuts that leave slices of about ``rows`` rows in the ``large`` groups, to be passed to
    ``mark``, and the number of earlier rows per slice: ``_key_*``, ``_path``, ``_start``.

    ``numbers`` never fall along the order, each among rows equal in those before it. Rows that agree
    in all of them stay together.
    """
    narrow = df.select(*[quoted(k) for k in keys], *[n.alias(f"_n{i}") for i, n in enumerate(numbers)])
    values = [F.col(f"_n{i}") for i in range(len(numbers))]
    names = [f"_key_{i}" for i in range(len(keys))]
    known = if_small(large)
    narrow = narrow.join(known, matches(narrow, keys, known), "left_semi")
    wanted = F.least(F.ceil(F.col("_rows") / rows), F.lit(CUTS)).cast("int").alias("_wanted")
    over = large.select(*names, F.array().cast("array<int>").alias("_path"), F.lit(0).alias("_which"), wanted)
    cuts: list[DataFrame] = []
    while True:
        cuts.append(if_small(_sketched(mark(narrow, keys, values, cuts), keys, values, over)))
        spread = [F.when(F.min(F.coalesce(v, F.lit(FIRST))) < F.max(F.coalesce(v, F.lit(FIRST))), F.lit(i)) for i, v in enumerate(values)]
        counts = keep(
            mark(narrow, keys, values, cuts).groupBy(*[quoted(k).alias(n) for k, n in zip(keys, names)], F.col("_slice").alias("_path"))
            .agg(F.count(F.lit(1)).alias("_rows"), F.coalesce(*spread).alias("_which")))
        over = keep(counts.where((F.col("_rows") > 2 * rows) & F.col("_which").isNotNull()).select(*names, "_path", "_which", wanted))
        if over.isEmpty():
            break
    earlier = Window.partitionBy(*names).orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    starts = keep(counts.select(*names, "_path", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")))
    return cuts, if_small(starts)


def numbered(df: DataFrame, keys: Sequence[str], numbers: Sequence[Column], order_by: Sequence[Column], out: str,
             cuts: Sequence[DataFrame], starts: DataFrame) -> DataFrame:
    """Every row once: numbered within its slice, or its group, and moved by the rows of earlier slices."""
    group = [quoted(k) for k in keys]
    place = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order_by)).cast("bigint")
    placed = mark(df, keys, numbers, cuts).withColumn("_place", place)
    same = reduce(lambda a, b: a & b, [matches(placed, keys, starts), placed["_slice"] == starts["_path"]])
    return placed.join(starts, same, "left").select(
        *[quoted(c) for c in df.columns if c != out], (F.col("_place") + F.coalesce("_start", F.lit(0))).alias(out))
