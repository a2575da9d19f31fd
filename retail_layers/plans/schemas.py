"""Source tables: types, keys and references.

Fixed values: names, types and constraints are those of the operational database and
the two JSON feeds whose tables this library reads. Identifiers are wider than there, so
that merged or much larger exports cannot overflow them.
"""

from __future__ import annotations

STAMPS = "created_at timestamp not null, updated_at timestamp not null"

RELATIONAL: dict[str, str] = {
    "customer_status": "status_code string not null, description string not null",
    "address_type": "address_type_code string not null, description string not null",
    "country": "country_code string not null, country_name string not null",
    "brand": f"brand_id bigint not null, brand_name string not null, description string, {STAMPS}",
    "category": (
        "category_id bigint not null, category_name string not null, parent_category_id bigint, "
        f"category_level int not null, {STAMPS}"
    ),
    "currency": "currency_code string not null, currency_name string not null, symbol string not null",
    "order_status": "order_status_code string not null, description string not null",
    "order_channel": "order_channel_code string not null, description string not null",
    "payment_method": "payment_method_code string not null, description string not null",
    "payment_status": "payment_status_code string not null, description string not null",
    "refund_reason": "refund_reason_code string not null, description string not null",
    "refund_status": "refund_status_code string not null, description string not null",
    "carrier": "carrier_id bigint not null, carrier_name string not null, contact_phone string, website_url string",
    "shipment_status": "shipment_status_code string not null, description string not null",
    "promotion": (
        "promotion_id bigint not null, promotion_code string not null, promotion_name string not null, "
        "discount_type string not null, discount_value decimal(10,2) not null, "
        "start_date timestamp not null, end_date timestamp, min_order_amount decimal(10,2), "
        "max_discount_amount decimal(10,2), is_active boolean not null"
    ),
    "customer": (
        "customer_id bigint not null, first_name string not null, last_name string not null, "
        "email string not null, phone_number string, date_of_birth date, gender string, "
        f"status_code string not null, {STAMPS}"
    ),
    "customer_address": (
        "customer_address_id bigint not null, customer_id bigint not null, address_line1 string not null, "
        "address_line2 string, landmark string, city string not null, state string not null, "
        "postal_code string not null, country_code string not null, "
        f"address_type_code string not null, is_default boolean not null, {STAMPS}"
    ),
    "product": (
        "product_id bigint not null, product_name string not null, brand_id bigint not null, "
        f"default_category_id bigint not null, short_description string, {STAMPS}, is_active boolean not null"
    ),
    "product_variant": (
        "product_variant_id bigint not null, product_id bigint not null, sku string not null, "
        f"variant_name string not null, {STAMPS}, is_active boolean not null"
    ),
    "warehouse": (
        "warehouse_id bigint not null, warehouse_name string not null, address_line1 string not null, "
        "address_line2 string, city string not null, state string not null, postal_code string not null, "
        f"country_code string not null, {STAMPS}"
    ),
    "inventory_level": (
        "warehouse_id bigint not null, product_variant_id bigint not null, on_hand_qty int not null, "
        "reserved_qty int not null, last_updated_at timestamp not null"
    ),
    "orders": (
        "order_id bigint not null, customer_id bigint not null, order_date timestamp not null, "
        "order_status_code string not null, order_channel_code string not null, "
        "currency_code string not null, billing_address_id bigint not null, shipping_address_id bigint not null, "
        "total_item_amount decimal(12,2) not null, total_discount_amount decimal(12,2) not null, "
        "total_tax_amount decimal(12,2) not null, total_shipping_amount decimal(12,2) not null, "
        f"grand_total_amount decimal(12,2) not null, {STAMPS}"
    ),
    "order_item": (
        "order_item_id bigint not null, order_id bigint not null, product_variant_id bigint not null, "
        "quantity int not null, base_unit_price decimal(12,2) not null, "
        "discount_amount decimal(12,2) not null, tax_amount decimal(12,2) not null, "
        f"shipping_amount decimal(12,2) not null, line_total_amount decimal(12,2) not null, {STAMPS}"
    ),
    "shipment": (
        "shipment_id bigint not null, order_id bigint not null, warehouse_id bigint not null, "
        "carrier_id bigint not null, shipment_status_code string not null, tracking_number string, "
        f"shipped_date timestamp, delivered_date timestamp, {STAMPS}"
    ),
    "shipment_item": "shipment_id bigint not null, order_item_id bigint not null, shipped_quantity int not null",
    "payment": (
        "payment_id bigint not null, order_id bigint not null, payment_method_code string not null, "
        "payment_status_code string not null, amount decimal(12,2) not null, "
        "currency_code string not null, transaction_reference string, "
        f"payment_date timestamp not null, {STAMPS}"
    ),
    "refund": (
        "refund_id bigint not null, payment_id bigint not null, order_id bigint not null, "
        "refund_amount decimal(12,2) not null, currency_code string not null, "
        "refund_reason_code string not null, refund_status_code string not null, "
        f"refund_date timestamp not null, {STAMPS}"
    ),
    "order_promotion": (
        "order_promotion_id bigint not null, order_id bigint not null, promotion_id bigint not null, "
        "discount_amount_applied decimal(12,2) not null"
    ),
}

# The JSON feeds. Attributes and metadata differ from row to row, hence variants.
JSON_FEEDS: dict[str, str] = {
    "product_attributes": (
        "product_id string, category_code string, source_system string, effective_from string, "
        "effective_to string, attributes variant"
    ),
    "product_reviews": (
        "review_id string, product_id string, customer_id string, rating string, review_title string, "
        "review_text string, review_date string, helpful_votes int, source string, status string, "
        "moderation_notes string, metadata variant"
    ),
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "customer_status": ("status_code",),
    "address_type": ("address_type_code",),
    "country": ("country_code",),
    "brand": ("brand_id",),
    "category": ("category_id",),
    "currency": ("currency_code",),
    "order_status": ("order_status_code",),
    "order_channel": ("order_channel_code",),
    "payment_method": ("payment_method_code",),
    "payment_status": ("payment_status_code",),
    "refund_reason": ("refund_reason_code",),
    "refund_status": ("refund_status_code",),
    "carrier": ("carrier_id",),
    "shipment_status": ("shipment_status_code",),
    "promotion": ("promotion_id",),
    "customer": ("customer_id",),
    "customer_address": ("customer_address_id",),
    "product": ("product_id",),
    "product_variant": ("product_variant_id",),
    "warehouse": ("warehouse_id",),
    "inventory_level": ("warehouse_id", "product_variant_id"),
    "orders": ("order_id",),
    "order_item": ("order_item_id",),
    "shipment": ("shipment_id",),
    "shipment_item": ("shipment_id", "order_item_id"),
    "payment": ("payment_id",),
    "refund": ("refund_id",),
    "order_promotion": ("order_promotion_id",),
}

UNIQUE_COLUMNS: dict[str, str] = {
    "promotion": "promotion_code",
    "customer": "email",
    "product_variant": "sku",
}

# (child table, child column, parent table); the parent column is its primary key
REFERENCES: tuple[tuple[str, str, str], ...] = (
    ("category", "parent_category_id", "category"),
    ("customer", "status_code", "customer_status"),
    ("customer_address", "customer_id", "customer"),
    ("customer_address", "country_code", "country"),
    ("customer_address", "address_type_code", "address_type"),
    ("product", "brand_id", "brand"),
    ("product", "default_category_id", "category"),
    ("product_variant", "product_id", "product"),
    ("warehouse", "country_code", "country"),
    ("inventory_level", "warehouse_id", "warehouse"),
    ("inventory_level", "product_variant_id", "product_variant"),
    ("orders", "customer_id", "customer"),
    ("orders", "order_status_code", "order_status"),
    ("orders", "order_channel_code", "order_channel"),
    ("orders", "currency_code", "currency"),
    ("orders", "billing_address_id", "customer_address"),
    ("orders", "shipping_address_id", "customer_address"),
    ("order_item", "order_id", "orders"),
    ("order_item", "product_variant_id", "product_variant"),
    ("shipment", "order_id", "orders"),
    ("shipment", "warehouse_id", "warehouse"),
    ("shipment", "carrier_id", "carrier"),
    ("shipment", "shipment_status_code", "shipment_status"),
    ("shipment_item", "shipment_id", "shipment"),
    ("shipment_item", "order_item_id", "order_item"),
    ("payment", "order_id", "orders"),
    ("payment", "payment_method_code", "payment_method"),
    ("payment", "payment_status_code", "payment_status"),
    ("payment", "currency_code", "currency"),
    ("refund", "payment_id", "payment"),
    ("refund", "order_id", "orders"),
    ("refund", "currency_code", "currency"),
    ("refund", "refund_reason_code", "refund_reason"),
    ("refund", "refund_status_code", "refund_status"),
    ("order_promotion", "order_id", "orders"),
    ("order_promotion", "promotion_id", "promotion"),
)
