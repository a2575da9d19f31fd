"""Gold marts: daily sales by product and by customer, reviews, payments.

The sales marts aggregate on the key first and look the attributes up afterwards. With
a dimension that is unique on its key this equals grouping by the attributes too, but
the exchange carries narrow rows, a hot product or customer is combined before it, and
the lookup handles one row per group instead of one per sale.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_layers.functions import dates, numbers
from retail_layers.operators.columns import quoted, wall_clocks
from retail_layers.operators.joins import lookup_left
from retail_layers.operators.keys import TASK_ROWS
from retail_layers.operators.skew import keys_above

# Attribute columns of the two sales marts.
PRODUCT_ATTRIBUTES = ("product_id", "product_name", "brand_id", "brand_name",
                      "default_category_id", "default_category_name")
CUSTOMER_ATTRIBUTES = ("age_band", "is_active_flag", "city_normalized", "state_normalized",
                       "is_metro_city")


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def _with_attributes(df: DataFrame, keys: Sequence[str], dim: DataFrame | None, dim_key: str,
                     attributes: Sequence[str], totals) -> DataFrame:
    """Group ``df`` by those of its ``keys`` it has, total, then add the attributes of ``dim``."""
    if dim is None or dim_key not in df.columns:
        group = _present(df, [*keys, *attributes])
        return df.groupBy(*map(quoted, group)).agg(*totals)
    group = _present(df, keys)
    added = _present(dim, attributes)
    summed = df.groupBy(*map(quoted, group)).agg(*totals)
    measures = [c for c in summed.columns if c not in group]
    return lookup_left(summed, dim, dim_key, added).select(*map(quoted, [*group, *added, *measures]))


def daily_sales_by_product(items: DataFrame, variants: DataFrame | None = None,
                           max_key_rows: int | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """``max_key_rows`` says that ``items`` are stored, so that counting them first is cheap, or that
    ``sizes`` is a cheaper frame to count them on: if no variant has more rows they are shuffled once, by
    variant, for totals, orders and attributes alike, into tasks of about ``TASK_ROWS`` rows."""
    counted = items if sizes is None else sizes
    used = ["order_date_key", "product_variant_key", "order_id", "quantity", "gross_amount", "discount_amount",
            "tax_amount", "shipping_amount", "net_line_amount"]
    if (variants is not None and max_key_rows is not None and "product_variant_key" in items.columns
            and keys_above(counted, ["product_variant_key"], max_key_rows) is None):
        tasks = max(2, -(-counted.count() // TASK_ROWS))
        items = items.select(*map(quoted, _present(items, used))).repartition(tasks, "product_variant_key")
    totals = [
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("gross_amount").alias("total_gross_sales"),
        F.sum("discount_amount").alias("total_discount_given"),
        F.sum("tax_amount").alias("total_tax_collected"),
        F.sum("shipping_amount").alias("total_shipping_charged"),
        F.sum("net_line_amount").alias("total_net_sales"),
        F.count_distinct("order_id").alias("distinct_orders"),
    ]
    return _with_attributes(items, ["order_date_key", "product_variant_key"], variants,
                            "product_variant_key", PRODUCT_ATTRIBUTES, totals)


def daily_sales_by_customer(orders: DataFrame, customers: DataFrame | None = None,
                            unique_orders: bool = False) -> DataFrame:
    """``unique_orders`` states that ``order_id`` is unique in ``orders``, as it is in a
    ``fact_orders`` built here; counting then needs no second exchange."""
    count = F.count("order_id") if unique_orders else F.count_distinct("order_id")
    totals = [
        count.alias("order_count"),
        F.sum("grand_total_amount").alias("total_revenue"),
        numbers.mean(F.col("grand_total_amount")).alias("avg_order_value"),
        F.count_if("is_first_order").alias("first_order_count"),
        F.count_if(~F.col("is_first_order")).alias("repeat_order_count"),
    ]
    return _with_attributes(orders, ["order_date_key", "customer_key"], customers,
                            "customer_key", CUSTOMER_ATTRIBUTES, totals)


def review_summary(reviews: DataFrame, zone: str | None = None) -> DataFrame:
    if "review_date" in reviews.columns:
        reviews = reviews.withColumn("review_date_key", dates.date_key(wall_clocks(reviews, zone)("review_date")))
    return reviews.groupBy(*_present(reviews, ["product_id", "review_date_key"])).agg(
        F.count("review_id").alias("total_reviews"),
        numbers.mean(F.col("rating")).alias("avg_rating"),
        F.count_if(F.col("rating") >= 4).alias("positive_reviews"),
        F.count_if(F.col("rating") == 3).alias("neutral_reviews"),
        F.count_if(F.col("rating") <= 2).alias("negative_reviews"),
        F.count_if("is_helpful_review").alias("helpful_reviews"),
    )


def payment_summary(payments: DataFrame, zone: str | None = None) -> DataFrame:
    if "payment_date" in payments.columns:
        payments = payments.withColumn("payment_date_key", dates.date_key(wall_clocks(payments, zone)("payment_date")))
    group = _present(payments, ["payment_date_key", "payment_method_code", "payment_status_code"])
    return payments.groupBy(*group).agg(
        F.count("payment_id").alias("payment_attempts"),
        F.count_if("is_successful").alias("successful_payments"),
        F.count_if("is_failed").alias("failed_payments"),
        F.sum("amount").alias("total_amount"),
        numbers.mean(F.col("amount")).alias("avg_payment_amount"),
    )


def build_marts(star: Mapping[str, DataFrame], unique_orders: bool = False,
                zone: str | None = None, max_key_rows: int | None = None,
                sizes: DataFrame | None = None) -> dict[str, DataFrame]:
    """The marts whose facts exist; days of reviews and payments are cut in ``zone``, or in
    the session's zone if it is None. ``max_key_rows`` is for facts that are stored or
    whose lines can be counted on ``sizes``, see ``daily_sales_by_product``."""
    marts: dict[str, DataFrame] = {}
    if "fact_order_items" in star:
        marts["gold_daily_sales_product"] = daily_sales_by_product(
            star["fact_order_items"], star.get("dim_product_variant"), max_key_rows, sizes)
    if "fact_orders" in star:
        marts["gold_daily_sales_customer"] = daily_sales_by_customer(
            star["fact_orders"], star.get("dim_customer"), unique_orders)
    if "fact_product_reviews" in star:
        marts["gold_product_review_summary"] = review_summary(star["fact_product_reviews"], zone)
    if "fact_payments" in star:
        marts["gold_payment_summary"] = payment_summary(star["fact_payments"], zone)
    return marts
