"""Keyed upsert as a plan: existing keys replaced, new keys added, the rest kept."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_layers.operators.columns import quoted, sortable
from retail_layers.operators.keys import first_per_group

POLICIES = ("incoming_wins", "latest_wins")


def precombine(batch: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key inside a batch: the greatest ``order_col``, a missing one losing.

    Rows that tie are settled by their other columns, so reruns agree.
    """
    rest = [c for c in batch.columns if c not in keys and c != order_col]
    return first_per_group(
        batch, keys,
        [quoted(order_col).desc_nulls_last(), *[sortable(batch, c).asc_nulls_first() for c in rest]],
    )


def refuse_missing(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, which fails as it runs when one of ``keys`` is NULL: such a row could never be found again."""
    return df.withColumns({
        k: F.coalesce(quoted(k), F.raise_error(F.lit(f"key column {k} is NULL"))) for k in keys})


def aligned(base: DataFrame, batch: DataFrame, evolve: bool) -> tuple[DataFrame, DataFrame]:
    """Both with the same columns in the order of ``base``, new ones last.

    Without ``evolve`` a column that only one side has is an error; with it the other side
    has NULLs there. A column of another type is an error in either case.
    """
    held, given = ({f.name: f.dataType for f in df.schema.fields} for df in (base, batch))
    other = sorted(c for c in held.keys() & given.keys() if held[c] != given[c])
    if other:
        raise ValueError(f"columns of another type: {', '.join(f'{c} {given[c].simpleString()}' for c in other)}")
    odd = sorted(held.keys() ^ given.keys())
    if odd and not evolve:
        raise ValueError(f"columns on one side only: {odd}")
    names = [*held, *[c for c in given if c not in held]]
    kinds = given | held

    def whole(df: DataFrame) -> DataFrame:
        return df.select(*[quoted(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names])

    return whole(base), whole(batch)


def matching(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A join of two frames on ``keys``, NULL matching NULL; the right side's keys are left out."""
    names = {k: f"_right_{i}" for i, k in enumerate(keys)}
    renamed = right.select(*[quoted(c).alias(names.get(c, c)) for c in right.columns])
    same = reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(renamed[n]) for k, n in names.items()])
    return left.join(renamed, same, how).drop(*names.values())


def upsert(base: DataFrame, batch: DataFrame, keys: Sequence[str], order_col: str,
           policy: str = "incoming_wins", precombined: bool = False, may_be_missing: Sequence[str] = (),
           evolve: bool = False) -> DataFrame:
    """``base`` after ``batch``. ``base`` is unique on ``keys``; ``batch`` need not be,
    unless it is said to be ``precombined``.

    ``incoming_wins`` replaces a known key always, ``latest_wins`` only when the batch
    row is not older (a base row without ``order_col`` gives way, a batch row without
    it loses to one that has it). To match keys within a partition only, make the
    partition column one of ``keys``. A NULL in one of ``keys`` is an error, except in the
    columns that ``may_be_missing``, where NULL matches NULL. Columns are those of both
    sides when the table may ``evolve``; otherwise they have to be the same.

    Every join puts the batch, or what it hits, on the side that adaptive execution may
    broadcast, so a small batch does not shuffle the base. The batch is used several times:
    hand in a kept frame where it is costly to make.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    base, batch = aligned(base, batch, evolve)
    batch = refuse_missing(batch, [k for k in keys if k not in may_be_missing])
    whole = [quoted(c) for c in base.columns]
    incoming = batch if precombined else precombine(batch, keys, order_col)
    if policy == "latest_wins":
        hits = matching(base.select(*map(quoted, keys), quoted(order_col).alias("_held")),
                        incoming.select(*map(quoted, keys)), keys, "inner")
        older = F.col("_held").isNotNull() & (
            quoted(order_col).isNull() | (quoted(order_col) < F.col("_held")))
        incoming = matching(incoming, hits, keys, "left").where(~older).select(*whole)
    kept = matching(base, incoming.select(*map(quoted, keys)), keys, "left_anti")
    return kept.select(*whole).unionByName(incoming.select(*whole))
