"""Left-outer lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_layers.operators.columns import quoted
from retail_layers.operators.skew import MAX_BROADCAST_ROWS, is_small, keys_above, matches
from retail_layers.scratch import keep

SALTS = 1 << 16  # places the rows of hot keys are dealt to in a join they take no part in


def lookup_left(df: DataFrame, dim: DataFrame, on: str, cols: Sequence[str] | Mapping[str, str],
                dim_on: str | None = None, max_key_rows: int | None = None,
                sizes: DataFrame | None = None, dim_rows: int = 0) -> DataFrame:
    """Add ``cols`` of ``dim`` to every row of ``df``; rows without a match get NULLs.

    Only the key and the asked-for columns of ``dim`` take part, so nothing else can
    collide and the scan of ``dim`` is pruned. ``cols`` may map names to new names.
    ``dim`` has to be unique on its key (``dedup`` it, or check with ``duplicate_keys``).

    There is no broadcast hint on ``dim``: the size that decides is the one Spark
    measures, and past its threshold the join is sort-merged, with hot keys split where
    the join ends its stage. Before anything has run that size is the one of compressed files,
    many times smaller than the rows in memory; where ``dim_rows`` says that there are more than
    ``MAX_BROADCAST_ROWS``, the join is sort-merged whatever that size. An aggregation that reuses the join's partitioning keeps
    Spark from splitting; for that case ``max_key_rows`` names the rows above which a key
    is hot (``sizes`` may name a cheaper frame to count them on). What ``dim`` holds for
    the hot keys is written, measured and sent to the rows of ``df``, which are read once:
    in the shuffled join, rows of hot keys carry a NULL key and a salt, so they match
    nothing and go everywhere. If there are too many hot keys to send, the join is plain.
    """
    renames = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    right = dim.select(quoted(dim_on or on).alias(on),
                       *[quoted(c).alias(out) for c, out in renames.items()])
    if dim_rows > MAX_BROADCAST_ROWS:
        right = right.hint("merge")
    hot = None if max_key_rows is None else keys_above(df if sizes is None else sizes, [on], max_key_rows)
    if hot is None:
        return df.join(right, on, "left")
    names = {out: f"_hot_{i}" for i, out in enumerate(renames.values())}
    few = keep(  # one row per hot key, whether it is known or not
        hot.join(right, hot["_key_0"] == right[f"`{on}`"], "left")
        .select("_key_0", *[quoted(c).alias(n) for c, n in names.items()], F.lit(True).alias("_is_hot")))
    if not is_small(few):
        return df.join(right, on, "left")
    few = F.broadcast(few)
    told = df.join(few, matches(df, [on], few), "left")
    cold = F.col("_is_hot").isNull()
    told = told.withColumns({
        "_join_on": F.when(cold, quoted(on)),
        "_salt": F.when(cold & quoted(on).isNotNull(), 0).otherwise(1 + F.monotonically_increasing_id() % SALTS)})
    never = F.pmod(F.hash(quoted(on)), F.lit(1)).cast("bigint")  # a plain 0 would be folded out of the shuffle's keys
    right = right.select(quoted(on).alias("_dim_on"), never.alias("_dim_salt"),
                         *[quoted(c).alias(f"_dim{n}") for c, n in names.items()])
    joined = told.join(right, (told["_join_on"] == right["_dim_on"]) & (told["_salt"] == right["_dim_salt"]), "left")
    found = [F.when(cold, F.col(f"_dim{n}")).otherwise(F.col(n)).alias(c) for c, n in names.items()]
    return joined.select(*[quoted(c) for c in [on, *[c for c in df.columns if c != on]]], *found)
