"""All declared constraints checked on the retail-shaped tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retail_layers.plans import integrity
from retail_queries.layer_sql import with_ctes
from retail_queries.shapes import SHAPES, raw

TABLES = tuple(n for n in SHAPES if n not in ("product_attributes", "product_reviews"))

# Keys, references and mandatory columns among these tables.
UNIQUE = {
    "customer": ["customer_id", "email"], "customer_address": ["customer_address_id"], "brand": ["brand_id"],
    "category": ["category_id"], "product": ["product_id"], "product_variant": ["product_variant_id", "sku"],
    "promotion": ["promotion_id", "promotion_code"], "orders": ["order_id"], "order_item": ["order_item_id"],
    "inventory_level": ["warehouse_id, product_variant_id"], "payment": ["payment_id"], "refund": ["refund_id"],
}
REFERENCES = (
    ("category", "parent_category_id", "category", "category_id"),
    ("customer_address", "customer_id", "customer", "customer_id"),
    ("product", "brand_id", "brand", "brand_id"),
    ("product", "default_category_id", "category", "category_id"),
    ("product_variant", "product_id", "product", "product_id"),
    ("inventory_level", "product_variant_id", "product_variant", "product_variant_id"),
    ("orders", "customer_id", "customer", "customer_id"),
    ("orders", "billing_address_id", "customer_address", "customer_address_id"),
    ("orders", "shipping_address_id", "customer_address", "customer_address_id"),
    ("order_item", "order_id", "orders", "order_id"),
    ("order_item", "product_variant_id", "product_variant", "product_variant_id"),
    ("payment", "order_id", "orders", "order_id"),
    ("refund", "payment_id", "payment", "payment_id"),
    ("refund", "order_id", "orders", "order_id"),
)
OPTIONAL = {"parent_category_id", "phone_number", "date_of_birth", "gender", "address_line2", "landmark",
            "short_description", "end_date", "min_order_amount", "max_discount_amount", "transaction_reference"}


def _sql() -> str:
    rows = []
    for name, keys in UNIQUE.items():
        for cols in keys:
            present = " or ".join(f"{c.strip()} is not null" for c in cols.split(","))
            rows.append(f"select 'unique' as \"check\", '{name}' as table_name, '{cols}' as column_names, count(*) as violations "
                        f"from (select {cols} from raw_{name} where {present} group by {cols} having count(*) > 1)")
    for child, col, parent, key in REFERENCES:
        rows.append(f"select 'reference', '{child}', '{col}', count(*) from raw_{child} c where {col} is not null "
                    f"and not exists (select 1 from raw_{parent} p where p.{key} = c.{col})")
    for name in TABLES:
        for col in SHAPES[name][1]:
            if col not in OPTIONAL:
                rows.append(f"select 'not null', '{name}', '{col}', count(*) - count({col}) from raw_{name}")
    return with_ctes(" union all ".join(rows))


def integrity_report(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.report({name: raw(spark, sf, name) for name in TABLES})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"integrity_report": integrity_report}
ORACLE: dict[str, str] = {"integrity_report": _sql()}
