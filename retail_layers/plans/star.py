"""Star schema: five dimensions and four facts from the enriched tables.

One function per table, each taking only the frames it needs. A lookup that is absent
leaves typed NULL columns, so every table always has its full set of columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_layers.functions import dates
from retail_layers.operators.columns import conform, project, wall_clocks
from retail_layers.operators.derive import Rule, derive
from retail_layers.operators.joins import lookup_left
from retail_layers.operators.keys import dedup, first_per_group, tie_break
from retail_layers.operators.skew import MAX_GROUP_ROWS

# Columns of each star table in order. A type is used only for a column
# that the sources lack.
DIM_DATE = ("date_key int, date date, year int, quarter int, month int, month_name string, "
            "weekofyear int, day int, day_of_week string")
DIM_CUSTOMER = (
    "customer_key bigint, first_name string, last_name string, full_name string, email string, "
    "email_is_valid boolean, phone_number string, phone_is_valid boolean, gender string, "
    "date_of_birth date, birth_year int, age_years bigint, age_band string, status_code string, "
    "is_active_flag boolean, address_line1 string, address_line2 string, landmark string, city string, "
    "state string, postal_code string, country_code string, city_normalized string, "
    "state_normalized string, is_metro_city boolean, ingestion_ts timestamp"
)
DIM_PRODUCT = (
    "product_key bigint, product_name string, product_name_search string, brand_id bigint, brand_name string, "
    "default_category_id bigint, default_category_name string, parent_category_id bigint, category_level int, "
    "short_description string, is_active boolean, is_active_flag boolean, created_at timestamp, "
    "updated_at timestamp, ingestion_ts timestamp"
)
DIM_PRODUCT_VARIANT = (
    "product_variant_key bigint, product_id bigint, sku string, sku_normalized string, variant_name string, "
    "variant_key string, product_name string, product_name_search string, brand_id bigint, "
    "brand_name string, default_category_id bigint, default_category_name string, is_active boolean, "
    "created_at timestamp, updated_at timestamp, ingestion_ts timestamp"
)
DIM_PROMOTION = (
    "promotion_key bigint, promotion_code string, promotion_name string, discount_type string, "
    "discount_value decimal(10,2), min_order_amount decimal(10,2), max_discount_amount decimal(10,2), "
    "start_date timestamp, end_date timestamp, is_active boolean, is_percentage_discount boolean, "
    "is_flat_discount boolean, is_currently_active boolean, ingestion_ts timestamp"
)
FACT_ORDERS = (
    "order_id bigint, customer_key bigint, order_date timestamp, order_date_key int, order_status_code string, "
    "order_status_is_valid boolean, order_channel_code string, currency_code string, "
    "billing_address_id bigint, shipping_address_id bigint, total_item_amount decimal(12,2), "
    "total_discount_amount decimal(12,2), total_tax_amount decimal(12,2), "
    "total_shipping_amount decimal(12,2), grand_total_amount decimal(12,2), order_value_band string, "
    "customer_order_sequence bigint, is_first_order boolean, amount_mismatch_flag boolean, "
    "created_at timestamp, updated_at timestamp, ingestion_ts timestamp"
)
FACT_ORDER_ITEMS = (
    "order_item_id bigint, order_id bigint, customer_key bigint, product_variant_key bigint, order_date_key int, "
    "quantity int, base_unit_price decimal(12,2), discount_amount decimal(12,2), "
    "tax_amount decimal(12,2), shipping_amount decimal(12,2), gross_amount decimal(18,2), "
    "effective_discount_pct double, net_line_amount decimal(18,2), created_at timestamp, "
    "updated_at timestamp, ingestion_ts timestamp"
)
FACT_PAYMENTS = (
    "payment_id bigint, order_id bigint, payment_method_code string, payment_status_code string, "
    "is_successful boolean, is_failed boolean, payment_attempt_number bigint, amount decimal(12,2), "
    "currency_code string, transaction_reference string, payment_date timestamp, created_at timestamp, "
    "updated_at timestamp, ingestion_ts timestamp"
)
FACT_PRODUCT_REVIEWS = (
    "review_id string, product_id string, customer_id string, rating int, "
    "rating_was_out_of_range boolean, review_title string, review_text string, review_length_chars int, "
    "review_sentiment_label string, helpful_votes int, is_helpful_review boolean, source string, "
    "status string, review_status_is_valid boolean, review_date timestamp, metadata variant, "
    "ingestion_ts timestamp"
)
DEFAULT_ADDRESS_TYPE = "HOME"
ADDRESS_COLUMNS = ("address_line1", "address_line2", "landmark", "city", "state", "postal_code",
                   "country_code", "city_normalized", "state_normalized", "is_metro_city")
PRODUCT_COLUMNS = ("product_name", "product_name_search", "brand_id", "brand_name",
                   "default_category_id", "default_category_name")


def dim_date(orders: DataFrame, zone: str | None = None) -> DataFrame:
    """One row per distinct order date; duplicates go before the exchange."""
    days = orders.select(F.to_date(wall_clocks(orders, zone)("order_date")).alias("date")).where(F.col("date").isNotNull()).distinct()
    return days.select(
        dates.date_key(F.col("date")).alias("date_key"), "date",
        F.year("date").alias("year"), F.quarter("date").alias("quarter"),
        F.month("date").alias("month"), F.date_format("date", "MMMM").alias("month_name"),
        F.weekofyear("date").alias("weekofyear"), F.dayofmonth("date").alias("day"),
        F.date_format("date", "E").alias("day_of_week"),
    )


def default_address(addresses: DataFrame, address_type: str = DEFAULT_ADDRESS_TYPE) -> DataFrame:
    """The earliest default address of the given type per customer."""
    wanted = F.col("is_default").cast("boolean") & (F.col("address_type_code") == address_type)
    tie = tie_break(addresses, "customer_address_id", ("customer_id", "created_at"))
    return first_per_group(addresses.where(wanted), ["customer_id"],
                           [F.col("created_at").asc_nulls_first(), *tie])


def dim_customer(customer: DataFrame, addresses: DataFrame | None = None) -> DataFrame:
    """Every customer once, with the default home address if there is one."""
    if addresses is not None:
        found = [c for c in ADDRESS_COLUMNS if c in addresses.columns]
        customer = lookup_left(customer, default_address(addresses), "customer_id", found)
    return project(customer.withColumnRenamed("customer_id", "customer_key"), DIM_CUSTOMER)


def dim_product(product: DataFrame, brand: DataFrame | None = None,
                category: DataFrame | None = None) -> DataFrame:
    if brand is not None and "brand_id" in product.columns:
        product = lookup_left(product, dedup(brand.select("brand_id", "brand_name"), ["brand_id"]),
                              "brand_id", ["brand_name"])
    if category is not None and "default_category_id" in product.columns:
        named = {"category_name": "default_category_name", "parent_category_id": "parent_category_id",
                 "category_level": "category_level"}
        product = lookup_left(product, dedup(category.select("category_id", *named), ["category_id"]),
                              "default_category_id", named, dim_on="category_id")
    return project(product.withColumnRenamed("product_id", "product_key"), DIM_PRODUCT)


def dim_product_variant(variant: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Every variant with its product's columns; ``products`` is ``dim_product``."""
    if products is not None and "product_id" in variant.columns:
        variant = lookup_left(variant, products, "product_id", PRODUCT_COLUMNS, dim_on="product_key")
    return project(variant.withColumnRenamed("product_variant_id", "product_variant_key"),
                   DIM_PRODUCT_VARIANT)


def dim_promotion(promotion: DataFrame) -> DataFrame:
    return project(promotion.withColumnRenamed("promotion_id", "promotion_key"), DIM_PROMOTION)


def fact_orders(orders: DataFrame, zone: str | None = None) -> DataFrame:
    moment = wall_clocks(orders, zone)
    keyed = derive(orders, Rule("order_date_key", ("order_date",), lambda: dates.date_key(moment("order_date"))))
    return project(keyed.withColumnRenamed("customer_id", "customer_key"), FACT_ORDERS)


def fact_order_items(items: DataFrame, orders: DataFrame | None = None,
                     max_key_rows: int | None = None, sizes: DataFrame | None = None, orders_rows: int = 0) -> DataFrame:
    """Every line with its order's customer and date key; ``orders`` is ``fact_orders``, of
    about ``orders_rows`` rows.

    Lines of orders with more than ``max_key_rows`` lines (counted on ``sizes``) are set
    apart and not shuffled, see ``lookup_left``.
    """
    if orders is not None and "order_id" in items.columns:
        items = lookup_left(items, orders, "order_id", ["customer_key", "order_date_key"],
                            max_key_rows=max_key_rows, sizes=sizes, dim_rows=orders_rows)
    return project(items.withColumnRenamed("product_variant_id", "product_variant_key"),
                   FACT_ORDER_ITEMS)


def fact_payments(payment: DataFrame) -> DataFrame:
    return project(payment, FACT_PAYMENTS)


def fact_product_reviews(reviews: DataFrame, typed_keys: bool = False) -> DataFrame:
    """The feed carries product and customer as text; ``typed_keys`` casts both to the
    dimensions' key type, NULL where the text is no number."""
    if typed_keys:
        reviews = conform(reviews, "product_id bigint, customer_id bigint")
    return project(reviews, FACT_PRODUCT_REVIEWS)


def base_tables(enriched: Mapping[str, DataFrame], typed_keys: bool = False,
                zone: str | None = None) -> dict[str, DataFrame]:
    """The star tables that read no other star table, for whichever sources exist.
    ``typed_keys`` gives the text keys of the feeds the dimensions' key type; days of
    instants are cut in ``zone``, or in the session's zone if it is None."""
    star: dict[str, DataFrame] = {}
    if "orders" in enriched:
        star["fact_orders"] = fact_orders(enriched["orders"], zone)
    if "customer" in enriched:
        star["dim_customer"] = dim_customer(enriched["customer"], enriched.get("customer_address"))
    if "product" in enriched:
        star["dim_product"] = dim_product(enriched["product"], enriched.get("brand"),
                                          enriched.get("category"))
    if "promotion" in enriched:
        star["dim_promotion"] = dim_promotion(enriched["promotion"])
    if "payment" in enriched:
        star["fact_payments"] = fact_payments(enriched["payment"])
    if "product_reviews" in enriched:
        star["fact_product_reviews"] = fact_product_reviews(enriched["product_reviews"], typed_keys)
    return star


def dependent_tables(enriched: Mapping[str, DataFrame], star: Mapping[str, DataFrame],
                     max_key_rows: int | None = MAX_GROUP_ROWS,
                     raw: Mapping[str, DataFrame] | None = None, zone: str | None = None) -> dict[str, DataFrame]:
    """The star tables that read ``base_tables``, best once those are written: the order
    date and customer of a line then come from a narrow scan of ``fact_orders`` instead
    of cleaning and numbering all orders again."""
    more: dict[str, DataFrame] = {}
    if "fact_orders" in star:
        more["dim_date"] = dim_date(star["fact_orders"], zone)
    if "product_variant" in enriched:
        more["dim_product_variant"] = dim_product_variant(enriched["product_variant"], star.get("dim_product"))
    if "order_item" in enriched:
        given = raw or {}
        more["fact_order_items"] = fact_order_items(enriched["order_item"], star.get("fact_orders"), max_key_rows,
                                                    given.get("order_item"), given["orders"].count() if "orders" in given else 0)
    return more


def build_star(enriched: Mapping[str, DataFrame], max_key_rows: int | None = MAX_GROUP_ROWS,
               raw: Mapping[str, DataFrame] | None = None, typed_keys: bool = False,
               zone: str | None = None) -> dict[str, DataFrame]:
    """All star tables as one set of lazy frames. Orders with more than ``max_key_rows``
    lines are set apart; ``raw`` holds the tables before cleaning, to find those on."""
    star = base_tables(enriched, typed_keys, zone)
    return star | dependent_tables(enriched, star, max_key_rows, raw, zone)
