"""Enrichment rules per table: derived columns, then sequence numbers where they apply."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_layers.functions import dates, numbers, text
from retail_layers.operators.columns import wall_clocks
from retail_layers.operators.derive import Rule, derive
from retail_layers.operators.keys import sequence, tie_break
from retail_layers.operators.skew import MAX_GROUP_ROWS
from retail_layers.operators.slices import order_number

Moment = Callable[[str], Column]

# Cities, band limits as (upper bound, label, inclusive), thresholds, codes.
METRO_CITIES = ("MUMBAI", "DELHI", "BENGALURU", "BANGALORE", "KOLKATA", "CHENNAI", "HYDERABAD", "PUNE")
AGE_BANDS = ((18, "UNDER_18", False), (25, "18_25", True), (35, "26_35", True), (45, "36_45", True))
AGE_TOP = "46_PLUS"
ORDER_VALUE_BANDS = ((2000, "LOW", False), (10000, "MEDIUM", True))
ORDER_VALUE_TOP = "HIGH"
SENTIMENT_BANDS = ((2, "BAD", True), (3, "NEUTRAL", True))
SENTIMENT_TOP = "GOOD"
LOW_STOCK_UNITS = 10
HELPFUL_VOTES = 5
ACTIVE_STATUS = "ACTIVE"
PAYMENT_SUCCESS, PAYMENT_FAILURE = "SUCCESS", "FAILED"
PERCENT_DISCOUNT, FLAT_DISCOUNT = "PERCENT", "AMOUNT"


def customer_rules(as_of: Column | date) -> tuple[Rule, ...]:
    return (
        Rule("full_name", ("first_name", "last_name"),
             lambda: F.concat_ws(" ", "first_name", "last_name")),
        Rule("birth_year", ("date_of_birth",), lambda: F.year("date_of_birth")),
        Rule("age_years", ("date_of_birth",), lambda: dates.whole_years(F.col("date_of_birth"), as_of)),
        Rule("age_band", ("age_years",), lambda: numbers.band(F.col("age_years"), AGE_BANDS, AGE_TOP)),
        Rule("is_active_flag", ("status_code",), lambda: F.col("status_code") == ACTIVE_STATUS),
    )


def address_rules(metro: Sequence[str] = METRO_CITIES) -> tuple[Rule, ...]:
    return (
        Rule("city_normalized", ("city",), lambda: text.upper_trimmed(F.col("city"))),
        Rule("state_normalized", ("state",), lambda: text.upper_trimmed(F.col("state"))),
        Rule("is_metro_city", ("city_normalized",), lambda: F.col("city_normalized").isin(list(metro))),
    )


def product_rules() -> tuple[Rule, ...]:
    return (
        Rule("product_name_search", ("product_name",), lambda: text.lower_trimmed(F.col("product_name"))),
        Rule("is_active_flag", ("is_active",), lambda: F.col("is_active").cast("boolean")),
    )


def variant_rules() -> tuple[Rule, ...]:
    return (
        Rule("sku_normalized", ("sku",), lambda: text.upper_trimmed(F.col("sku"))),
        Rule("variant_key", ("product_id", "sku"),
             lambda: F.concat_ws("|", F.col("product_id").cast("string"), F.col("sku"))),
    )


def stock_rules(low: int = LOW_STOCK_UNITS) -> tuple[Rule, ...]:
    return (
        Rule("available_qty", ("on_hand_qty", "reserved_qty"),
             lambda: (F.col("on_hand_qty") - F.col("reserved_qty")).cast("int")),
        Rule("is_out_of_stock", ("available_qty",), lambda: F.col("available_qty") <= 0),
        Rule("is_low_stock", ("available_qty",), lambda: F.col("available_qty").between(1, low)),
    )


def order_rules(moment: Moment = F.col) -> tuple[Rule, ...]:
    return (
        Rule("order_date_date", ("order_date",), lambda: F.to_date(moment("order_date"))),
        Rule("order_year", ("order_date",), lambda: F.year(moment("order_date"))),
        Rule("order_month", ("order_date",), lambda: F.month(moment("order_date"))),
        Rule("order_day", ("order_date",), lambda: F.dayofmonth(moment("order_date"))),
        Rule("order_weekofyear", ("order_date",), lambda: F.weekofyear(moment("order_date"))),
        Rule("order_value_band", ("grand_total_amount",),
             lambda: numbers.band(F.col("grand_total_amount"), ORDER_VALUE_BANDS, ORDER_VALUE_TOP)),
    )


def line_rules() -> tuple[Rule, ...]:
    return (
        Rule("gross_amount", ("quantity", "base_unit_price"),
             lambda: (F.col("quantity") * F.col("base_unit_price")).cast(numbers.LINE_TOTAL)),
        Rule("effective_discount_pct", ("discount_amount", "gross_amount"),
             lambda: numbers.percent_of(F.col("discount_amount"), F.col("gross_amount"))),
        Rule("net_line_amount", ("gross_amount", "discount_amount", "tax_amount", "shipping_amount"),
             lambda: (F.col("gross_amount") - F.col("discount_amount") + F.col("tax_amount")
                      + F.col("shipping_amount")).cast(numbers.LINE_TOTAL)),
    )


def payment_rules() -> tuple[Rule, ...]:
    return (
        Rule("is_successful", ("payment_status_code",), lambda: F.col("payment_status_code") == PAYMENT_SUCCESS),
        Rule("is_failed", ("payment_status_code",), lambda: F.col("payment_status_code") == PAYMENT_FAILURE),
    )


def review_rules() -> tuple[Rule, ...]:
    return (
        Rule("review_length_chars", ("review_text",), lambda: F.length("review_text")),
        Rule("review_sentiment_label", ("rating",),
             lambda: numbers.band(F.col("rating"), SENTIMENT_BANDS, SENTIMENT_TOP)),
        Rule("is_helpful_review", ("helpful_votes",), lambda: F.col("helpful_votes") >= HELPFUL_VOTES),
    )


def promotion_rules(as_of: Column | date, moment: Moment = F.col) -> tuple[Rule, ...]:
    interval = ("start_date", "end_date", "is_active")
    return (
        Rule("is_percentage_discount", ("discount_type",), lambda: F.col("discount_type") == PERCENT_DISCOUNT),
        Rule("is_flat_discount", ("discount_type",), lambda: F.col("discount_type") == FLAT_DISCOUNT),
        Rule("start_date_date", interval, lambda: F.to_date(moment("start_date"))),
        Rule("end_date_date", interval, lambda: F.to_date(moment("end_date"))),
        Rule("is_currently_active", ("is_active", "start_date_date", "end_date_date"),
             lambda: dates.within_validity(F.col("is_active"), F.col("start_date_date"),
                                           F.col("end_date_date"), as_of)),
    )


def rules_for(name: str, as_of: Column | date, moment: Moment = F.col) -> tuple[Rule, ...]:
    """The rules for ``name``; ``moment`` gives the column whose day, month and year count."""
    rules = {
        "customer": lambda: customer_rules(as_of),
        "customer_address": address_rules,
        "product": product_rules,
        "product_variant": variant_rules,
        "inventory_level": stock_rules,
        "orders": lambda: order_rules(moment),
        "order_item": line_rules,
        "payment": payment_rules,
        "product_reviews": review_rules,
        "promotion": lambda: promotion_rules(as_of, moment),
    }
    return rules[name]() if name in rules else ()


def _order_numbers(df: DataFrame, when: str, key: str) -> list[Column]:
    """What large groups may be cut on: the moment, then the row's key."""
    numbers = [order_number(df, c) for c in (when, key) if c in df.columns]
    return [n for n in numbers if n is not None] if numbers[0] is not None else []


def number_orders(df: DataFrame, max_group_rows: int = MAX_GROUP_ROWS,
                  sizes: DataFrame | None = None) -> DataFrame:
    """Place of each order among its customer's, undated ones first, ties by ``order_id``."""
    tie = tie_break(df, "order_id", ("customer_id", "order_date"))
    numbered = sequence(df, ["customer_id"], [F.col("order_date").asc_nulls_first(), *tie],
                        "customer_order_sequence", max_group_rows, sizes, _order_numbers(df, "order_date", "order_id"))
    return numbered.withColumn("is_first_order", F.col("customer_order_sequence") == 1)


def number_payments(df: DataFrame, max_group_rows: int = MAX_GROUP_ROWS,
                    sizes: DataFrame | None = None) -> DataFrame:
    """Attempt number of each payment within its order, ties by ``payment_id``."""
    tie = tie_break(df, "payment_id", ("order_id", "payment_date"))
    return sequence(df, ["order_id"], [F.col("payment_date").asc_nulls_first(), *tie],
                    "payment_attempt_number", max_group_rows, sizes, _order_numbers(df, "payment_date", "payment_id"))


NUMBERED = {
    "orders": (number_orders, ("customer_id", "order_date")),
    "payment": (number_payments, ("order_id", "payment_date")),
}


def enrich_table(name: str, df: DataFrame, as_of: Column | date,
                 max_group_rows: int = MAX_GROUP_ROWS, sizes: DataFrame | None = None,
                 zone: str | None = None) -> DataFrame:
    """Enrich one table by the rules for ``name``; a table without rules passes through.
    Days of instants are cut in ``zone``, or in the session's zone if it is None."""
    df = derive(df, *rules_for(name, as_of, wall_clocks(df, zone)))
    if name in NUMBERED:
        number, needs = NUMBERED[name]
        if set(needs) <= set(df.columns):
            key = needs[0]
            usable = (sizes is not None and key in sizes.columns
                      and sizes.schema[key].dataType == df.schema[key].dataType)
            df = number(df, max_group_rows, sizes if usable else None)
    return df


def enrich_tables(tables: Mapping[str, DataFrame], as_of: Column | date,
                  raw: Mapping[str, DataFrame] | None = None,
                  max_group_rows: int = MAX_GROUP_ROWS, zone: str | None = None) -> dict[str, DataFrame]:
    """Enrich every table. ``raw`` (the tables before cleaning) makes the check for very
    large groups a scan of one column instead of a second run of the cleaning."""
    raw = raw or {}
    return {name: enrich_table(name, df, as_of, max_group_rows, raw.get(name), zone)
            for name, df in tables.items()}
