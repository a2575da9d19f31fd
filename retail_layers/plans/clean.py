"""Cleaning rules per table.

Every table gets trimmed, blank-free strings and a load time. A table with rules then
runs its steps, loses rows without a key and keeps one row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_layers.functions import numbers, text
from retail_layers.operators.columns import (
    cast_integers,
    cast_timestamps,
    clamp_negative,
    clip_range,
    flag_in_set,
    generic_clean,
)
from retail_layers.operators.derive import Rule, derive
from retail_layers.operators.keys import dedup, dedup_rare, require_keys

# Accepted codes, money columns, limits.
CUSTOMER_STATUSES = ("ACTIVE", "INACTIVE", "BLOCKED")
ORDER_STATUSES = ("PENDING", "PAID", "SHIPPED", "DELIVERED", "CANCELLED")
PAYMENT_STATUSES = ("PENDING", "SUCCESS", "FAILED", "REFUNDED")
REVIEW_STATUSES = ("PUBLISHED", "PENDING", "REJECTED")
ORDER_TOTALS = ("total_item_amount", "total_discount_amount", "total_tax_amount",
                "total_shipping_amount", "grand_total_amount")
LINE_AMOUNTS = ("quantity", "base_unit_price", "discount_amount", "tax_amount",
                "shipping_amount", "line_total_amount")
STOCK_QUANTITIES = ("on_hand_qty", "reserved_qty")
TOTAL_TOLERANCE = Decimal("0.01")
RATING_RANGE = (1, 5)
MAX_REVIEW_CHARS = 5000

Step = Callable[[DataFrame], DataFrame]


def normalize_names(df: DataFrame, cols: Sequence[str] = ("first_name", "last_name")) -> DataFrame:
    return derive(df, *[Rule(c, (c,), lambda c=c: text.title_case(F.col(c))) for c in cols])


def clean_email(df: DataFrame, col: str = "email") -> DataFrame:
    return derive(df, Rule(col, (col,), lambda: text.lower_trimmed(F.col(col))),
                  Rule(f"{col}_is_valid", (col,), lambda: text.is_email(F.col(col))))


def clean_phone(df: DataFrame, col: str = "phone_number", out: str = "phone_is_valid") -> DataFrame:
    return derive(df, Rule(col, (col,), lambda: text.without_whitespace(F.col(col))),
                  Rule(out, (col,), lambda: text.has_digits(F.col(col))))


def normalize_product_name(df: DataFrame, col: str = "product_name") -> DataFrame:
    return derive(df, Rule(col, (col,), lambda: text.blank_to_null(text.trimmed(F.col(col)))))


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return derive(df, *[Rule(c, (c,), lambda c=c: text.trimmed(F.col(c))) for c in cols])


def flag_total_mismatch(df: DataFrame, total: str = "grand_total_amount",
                        added: Sequence[str] = ("total_item_amount", "total_tax_amount",
                                                "total_shipping_amount"),
                        subtracted: Sequence[str] = ("total_discount_amount",),
                        out: str = "amount_mismatch_flag",
                        tolerance: Decimal = TOTAL_TOLERANCE) -> DataFrame:
    """Whether ``total`` is off the sum of its parts; NULL when any part is missing."""
    def expr() -> Column:
        computed = sum((F.col(c) for c in added[1:]), F.col(added[0]))
        for c in subtracted:
            computed = computed - F.col(c)
        return numbers.differs(F.col(total), computed, tolerance)

    return derive(df, Rule(out, (total, *added, *subtracted), expr))


def clean_rating(df: DataFrame, col: str = "rating", low: int = RATING_RANGE[0],
                 high: int = RATING_RANGE[1]) -> DataFrame:
    """To int, flag what lies outside the range, then clip into it."""
    flagged = derive(cast_integers(df, col), Rule(
        f"{col}_was_out_of_range", (col,), lambda: numbers.outside(F.col(col), low, high)))
    return clip_range(flagged, col, low, high)


def limit_text(df: DataFrame, col: str = "review_text", max_length: int | None = MAX_REVIEW_CHARS) -> DataFrame:
    """Trim, flag over-long text, then cut it to ``max_length`` characters; None keeps it whole."""
    if max_length is None:
        return derive(
            df,
            Rule(col, (col,), lambda: text.trimmed(F.col(col))),
            Rule(f"{col}_was_truncated", (col,), lambda: F.when(F.col(col).isNotNull(), F.lit(False))),
        )
    return derive(
        df,
        Rule(col, (col,), lambda: text.trimmed(F.col(col))),
        Rule(f"{col}_was_truncated", (col,), lambda: text.is_longer_than(F.col(col), max_length)),
        Rule(col, (col,), lambda: text.cut(F.col(col), max_length)),
    )


@dataclass(frozen=True)
class TableRules:
    keys: tuple[str, ...]
    steps: tuple[Step, ...]
    required: tuple[str, ...] | None = None  # key columns that may not be NULL; default: all
    long: tuple[str, ...] = ()  # columns compared by their digest where rows of one key compete
    near: str | None = None  # column the table is joined on next; rows that have to be shuffled are dealt by it


@dataclass(frozen=True)
class Timestamps:
    """The step that makes text timestamps; it takes the zone of a run."""

    cols: tuple[str, ...]

    def __call__(self, df: DataFrame, zone: str | None = None) -> DataFrame:
        return cast_timestamps(df, *self.cols, zone=zone)


def _timestamps(*cols: str) -> Step:
    return Timestamps(cols)


def _codes(col: str, allowed: Sequence[str], out: str) -> Step:
    return partial(flag_in_set, col=col, allowed=allowed, out=out)


RULES: dict[str, TableRules] = {
    "customer": TableRules(("customer_id",), (
        normalize_names, clean_email, clean_phone,
        _codes("status_code", CUSTOMER_STATUSES, "status_code_is_valid"))),
    "orders": TableRules(("order_id",), (
        partial(clamp_negative, cols=ORDER_TOTALS), flag_total_mismatch,
        _codes("order_status_code", ORDER_STATUSES, "order_status_is_valid"),
        _timestamps("order_date"))),
    "order_item": TableRules(("order_item_id",), (partial(clamp_negative, cols=LINE_AMOUNTS),), near="order_id"),
    "product": TableRules(("product_id",), (normalize_product_name,)),
    "product_variant": TableRules(("product_variant_id",), (
        partial(trim_columns, cols=("sku", "variant_name")),)),
    "inventory_level": TableRules(("warehouse_id", "product_variant_id"), (
        partial(clamp_negative, cols=STOCK_QUANTITIES),)),
    "payment": TableRules(("payment_id",), (
        partial(clamp_negative, cols=("amount",)),
        _codes("payment_status_code", PAYMENT_STATUSES, "payment_status_is_valid"),
        _timestamps("payment_date"))),
    "refund": TableRules(("refund_id",), (
        partial(clamp_negative, cols=("refund_amount",)), _timestamps("refund_date"))),
    "product_attributes": TableRules(("product_id", "effective_from"), (
        _timestamps("effective_from", "effective_to"),), required=("product_id",)),
    "product_reviews": TableRules(("review_id",), (
        clean_rating, limit_text,
        _codes("status", REVIEW_STATUSES, "review_status_is_valid"),
        _timestamps("review_date")), long=("review_text", "metadata")),
}


def clean_table(name: str, df: DataFrame, run_ts: Column | datetime,
                null_tokens: Sequence[str] = (), rare_duplicates: bool = False,
                max_review_chars: int | None = MAX_REVIEW_CHARS, zone: str | None = None) -> DataFrame:
    """Clean one table by the rules for ``name``, or generically when there are none.

    ``rare_duplicates`` says that keys hardly ever repeat, as with tables exported from
    a database that enforces them; the result is the same, the wide shuffle is saved.
    Texts of reviews are cut to ``max_review_chars`` characters; None keeps them whole.
    Moments without an offset are read in ``zone``, or in the session's zone if it is None.
    """
    df = generic_clean(df, run_ts, null_tokens)
    rules = RULES.get(name)
    if rules is None:
        return df
    for step in rules.steps:
        if step is limit_text:
            df = step(df, max_length=max_review_chars)
        else:
            df = step(df, zone=zone) if isinstance(step, Timestamps) else step(df)
    keep_one = partial(dedup_rare, near=rules.near) if rare_duplicates else dedup
    return keep_one(require_keys(df, rules.required or rules.keys), rules.keys, long=rules.long)


def clean_tables(tables: Mapping[str, DataFrame], run_ts: Column | datetime,
                 null_tokens: Sequence[str] = (), rare_duplicates: bool = False,
                 max_review_chars: int | None = MAX_REVIEW_CHARS, at_once: int = 4,
                 zone: str | None = None) -> dict[str, DataFrame]:
    """Every table cleaned. With ``rare_duplicates`` repeated keys are looked for while the
    plans are built, up to ``at_once`` tables side by side."""
    def one(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, df = item
        return name, clean_table(name, df, run_ts, null_tokens, rare_duplicates, max_review_chars, zone)

    if not tables or not rare_duplicates:
        return dict(map(one, tables.items()))
    session = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(max_workers=min(at_once, len(tables))) as pool:
        return dict(pool.map(inheritable_thread_target(session)(one), tables.items()))
