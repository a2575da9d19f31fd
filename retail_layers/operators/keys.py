"""Key filters, deterministic deduplication and ranking within groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_layers.operators import slices
from retail_layers.operators.columns import digest, quoted, sortable
from retail_layers.operators.skew import MAX_GROUP_ROWS, is_small, keys_above, set_apart
from retail_layers.scratch import keep

# Names under which a table may hold the time of its rows' last update; the first one found counts.
UPDATE_COLUMNS = ("updated_at", "last_updated_at")
# Slices of a large group are not cut smaller than this; tasks over fewer rows cost more than they do.
LEAST_SLICE_ROWS = 1000
# Keys are rare while fewer than one row in so many shares its key with another row.
RARE = 50
# Whole rows are dealt so that one task sorts about so many, whatever the size of the table.
TASK_ROWS = 250_000


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with every key present, as plain filters that reach the file scan."""
    return df.where(reduce(lambda a, b: a & b, [quoted(k).isNotNull() for k in keys]))


def first_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The first row of each group; ``order_by`` has to be a total order.

    Spark keeps one row per group and map task before the exchange, so a group of any
    size reaches the reducer as at most one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*map(quoted, keys)).orderBy(*order_by))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def tie_break(df: DataFrame, key: str, used: Sequence[str]) -> list[Column]:
    """Order columns that settle ties: the row's key, or all other columns without one."""
    rest = [key] if key in df.columns else [c for c in df.columns if c not in used]
    return [sortable(df, c).asc_nulls_first() for c in rest]


def newest_first(df: DataFrame, keys: Sequence[str], long: Sequence[str] = ()) -> list[Column]:
    """A total order of the rows of one key: the last update first, then all other columns, NULLs last.

    ``long`` columns come last and by their digest, so no sort or exchange has to carry
    them unless the result does.
    """
    rest = [c for c in df.columns if c not in keys]
    when = [c for c in UPDATE_COLUMNS if c in rest][:1]
    return [*[quoted(c).desc_nulls_last() for c in when],
            *[sortable(df, c).asc_nulls_last() for c in rest if c not in when and c not in long],
            *[digest(df, c).asc_nulls_last() for c in rest if c in long]]


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None,
          long: Sequence[str] = ()) -> DataFrame:
    """One row per key (NULL keys are one key), the least by ``order_by``.

    Without ``order_by`` the row updated last stays; every other column takes part in
    order, NULLs last, so rows that still tie are equal and the result does not depend on
    their placement. Columns named as ``long`` take part last, by their digest.
    """
    if order_by is None:
        order_by = newest_first(df, keys, long)
    return first_per_group(df, keys, order_by) if order_by else df.dropDuplicates(list(keys))


def dedup_rare(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None,
               long: Sequence[str] = (), near: str | None = None) -> DataFrame:
    """``dedup`` for tables whose keys hardly ever repeat, such as exported primary keys.

    A first pass over the key columns finds the repeated keys. Only their rows are
    shuffled and ranked; all others pass straight through. As long as the list of
    repeated keys is small it is broadcast, and the table is not shuffled at all.

    Where keys turn out not to be rare (one row in ``RARE`` or more shares its key, at any
    size of the table) or their list is too large to be sent, the table is shuffled once
    instead, see ``dedup_dealt``; ``near`` names the column it is looked up by next.
    """
    repeated = keys_above(df, keys, 1, likely=True)
    if repeated is None:
        return df
    held, most = repeated.agg(F.sum("_rows"), F.max("_rows")).first()
    total = df.select(*map(quoted, keys)).count()
    if held * RARE > total or not is_small(repeated):
        return dedup_dealt(df, keys, order_by, long, near, total, most)
    copies, single = set_apart(df, keys, repeated)
    return single.unionByName(dedup(copies, keys, order_by, long))


def dedup_dealt(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None, long: Sequence[str],
                near: str | None, total: int, most: int) -> DataFrame:
    """``dedup`` by one shuffle of whole rows into tasks of about ``TASK_ROWS`` rows.

    ``total`` is the number of rows, ``most`` that of the most frequent key. Rows are dealt
    by ``near`` if it has no large group, so that a join on it needs no other shuffle; the
    few keys whose rows differ there are set apart. Without it they are dealt by key, and
    a key with too many rows for one task is cut down before the exchange, as in ``dedup``.
    """
    tasks = max(2, -(-total // TASK_ROWS))
    if most > MAX_GROUP_ROWS:
        return dedup(df, keys, order_by, long)
    if near in df.columns and near not in keys and keys_above(df, [near], MAX_GROUP_ROWS) is None:
        at, n = quoted(near), F.count(F.lit(1))
        apart = keep(
            df.groupBy(*[quoted(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
            .agg(F.min(at).alias("_low"), F.max(at).alias("_high"), F.count(at).alias("_known"), n.alias("_rows"))
            .where((F.col("_low") < F.col("_high")) | F.col("_known").between(1, F.col("_rows") - 1)))
        spread = not apart.isEmpty()
        if not spread or is_small(apart):
            copies, single = set_apart(df, keys, apart) if spread else (None, df)
            # of rows with one key the order decides among all other columns, of which ``near`` is one and the same
            order = order_by or newest_first(df, keys, long)
            one = first_per_group(single.repartition(tasks, at), [near, *keys], order)
            return one.unionByName(dedup(copies, keys, order_by, long)) if spread else one
    return dedup(df.repartition(tasks, *map(quoted, keys)), keys, order_by, long)


def sequence(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], out: str,
             max_group_rows: int = MAX_GROUP_ROWS, sizes: DataFrame | None = None,
             slice_on: Sequence[Column] = (), least_rows: int = LEAST_SLICE_ROWS) -> DataFrame:
    """Number the rows of each group from 1 in ``order_by`` order (a total order).

    Groups of more than ``max_group_rows`` rows are cut into slices along the order, none
    meant to hold fewer than ``least_rows``, so that no group has to meet in one task. Cut
    points come from a quantile sketch over ``slice_on``: whole numbers that never fall
    along the order, each among rows equal in those before it, NULLs first. A pass over the
    narrow columns counts the rows per slice. The rows themselves are read and shuffled
    once, by group and slice, whether groups are cut or not. Rows that agree in all of
    ``slice_on`` stay in one slice; without it no group is cut.

    ``sizes`` may name a cheaper frame to find the large groups on, such as the raw
    table. It only steers which way a group goes; the numbers are the same either way.
    """
    limit = max(max_group_rows, least_rows)
    large = keys_above(df if sizes is None else sizes, partition_by, limit) if slice_on else None
    if large is None:
        window = Window.partitionBy(*[quoted(c) for c in partition_by]).orderBy(*order_by)
        return df.withColumn(out, F.row_number().over(window).cast("bigint"))
    cuts, starts = slices.cut_groups(df, partition_by, slice_on, large, limit)
    return slices.numbered(df, partition_by, slice_on, order_by, out, cuts, starts)
