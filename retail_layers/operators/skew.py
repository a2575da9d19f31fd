"""Finding the few keys that hold very many rows, and setting their rows apart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_layers.operators.columns import quoted
from retail_layers.scratch import keep

# A group up to this many rows is handled by one task; larger ones are split.
MAX_GROUP_ROWS = 2_000_000
# A measured frame up to this size is sent to every executor; larger ones are shuffled.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A table of more rows is never sent whole, also where its compressed files look small enough.
MAX_BROADCAST_ROWS = 1_000_000


def keys_above(df: DataFrame, keys: Sequence[str], rows: int, likely: bool = False) -> DataFrame | None:
    """The keys held by more than ``rows`` rows with their ``_rows``, or None without any.

    Rows are counted before the exchange, so it carries at most one row per key and map
    task. The result is written down: it steers two branches that have to agree. When
    such keys are ``likely`` it is written at once, otherwise only after a look for one.
    """
    found = (
        df.groupBy(*[quoted(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > rows)
    )
    if likely:
        found = keep(found)
        return None if found.isEmpty() else found
    return None if found.isEmpty() else keep(found)


def matches(df: DataFrame, keys: Sequence[str], found: DataFrame) -> Column:
    """Null-safe equality of ``keys`` with a frame made by ``keys_above``."""
    return reduce(lambda a, b: a & b,
                  [df[f"`{k}`"].eqNullSafe(found[f"_key_{i}"]) for i, k in enumerate(keys)])


def is_small(kept: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a kept frame, measured as the bytes of all its values, is within ``limit``."""
    width = reduce(lambda a, b: a + b, [
        F.lit(16) + F.coalesce(F.octet_length(quoted(c).cast("string")), F.lit(0)) for c in kept.columns])
    return (kept.agg(F.sum(width.cast("bigint"))).first()[0] or 0) <= limit


def if_small(kept: DataFrame) -> DataFrame:
    """A kept frame with a broadcast hint once its size is known to be small."""
    return F.broadcast(kept) if is_small(kept) else kept


def set_apart(df: DataFrame, keys: Sequence[str], found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` under the found keys, and all other rows."""
    found = if_small(found)
    same = matches(df, keys, found)
    return df.join(found, same, "left_semi"), df.join(found, same, "left_anti")
