"""Schema-tolerant column derivation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class Rule:
    """One derived (or replaced) column and the columns it cannot do without."""

    out: str
    needs: tuple[str, ...]
    expr: Callable[[], Column]


def derive(df: DataFrame, *rules: Rule) -> DataFrame:
    """Apply ``rules`` in order, leaving out those whose inputs are absent.

    Rules that do not read one another's results share one ``withColumns``, which
    keeps the plan short for wide tables.
    """
    known = set(df.columns)
    batch: dict[str, Column] = {}
    for rule in rules:
        if not set(rule.needs) <= known:
            continue
        if rule.out in batch or batch.keys() & set(rule.needs):
            df, batch = df.withColumns(batch), {}
        batch[rule.out] = rule.expr()
        known.add(rule.out)
    return df.withColumns(batch) if batch else df
