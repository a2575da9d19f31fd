"""Every layer of the retail tables as plain SQL, written apart from the library."""

from __future__ import annotations

import re

from retail_queries.shapes import SHAPES, raw_sql

AS_OF = "2025-11-30"
RUN_TS = "2025-11-30 06:00:00"
STAMP = f"timestamp '{RUN_TS}' as ingestion_ts"


def text(*cols: str) -> str:
    return ", ".join(f"nullif(trim({c}), '') as {c}" for c in cols)


def clamp(dtype: str, *cols: str) -> str:
    return ", ".join(
        f"cast(case when {c} < 0 then 0 else {c} end as {dtype}) as {c}, coalesce({c} < 0, false) as {c}_was_negative"
        for c in cols)


def one_per_key(source: str, keys: str, others: str, required: str | None = None) -> str:
    names = [c.strip() for c in others.split(",")]
    when = [c for c in names if c in ("updated_at", "last_updated_at")]
    order = ", ".join([f"{c} desc nulls last" for c in when] + [f"{c} asc nulls last" for c in names if c not in when])
    present = " and ".join(f"{k.strip()} is not null" for k in (required or keys).split(","))
    return (f"select * from {source} where {present} "
            f"qualify row_number() over (partition by {keys} order by {order}) = 1")


def title(c: str) -> str:
    return (f"array_to_string(list_transform(string_split({c}, ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')")


def date_key(c: str) -> str:
    return f"cast(strftime({c}, '%Y%m%d') as int)"


MONEY12 = "decimal(12,2)"
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

CTES: dict[str, str] = {f"raw_{name}": raw_sql(name) for name in SHAPES}

CTES |= {
    "tidy_customer": f"""
        select customer_id, {text('first_name', 'last_name', 'email', 'phone_number', 'gender', 'status_code')},
               date_of_birth, {STAMP} from raw_customer""",
    "checked_customer": f"""
        select customer_id, {title('first_name')} as first_name, {title('last_name')} as last_name,
               lower(trim(email)) as email, regexp_matches(lower(trim(email)), '{EMAIL}') as email_is_valid,
               regexp_replace(phone_number, '\\s+', '', 'g') as phone_number,
               length(regexp_replace(phone_number, '\\D', '', 'g')) >= 6 as phone_is_valid,
               date_of_birth, gender, status_code,
               status_code in ('ACTIVE', 'INACTIVE', 'BLOCKED') as status_code_is_valid, ingestion_ts
        from tidy_customer""",
    "clean_customer": one_per_key(
        "checked_customer", "customer_id",
        "first_name, last_name, email, phone_number, date_of_birth, gender, status_code"),
    "tidy_orders": f"""
        select order_id, customer_id, order_date, {text('order_status_code', 'order_channel_code', 'currency_code')},
               billing_address_id, shipping_address_id,
               {clamp(MONEY12, 'total_item_amount', 'total_discount_amount', 'total_tax_amount',
                      'total_shipping_amount', 'grand_total_amount')},
               created_at, updated_at, {STAMP} from raw_orders""",
    "checked_orders": """
        select *, abs(grand_total_amount - (total_item_amount - total_discount_amount + total_tax_amount
                      + total_shipping_amount)) > 0.01 as amount_mismatch_flag,
               order_status_code in ('PENDING', 'PAID', 'SHIPPED', 'DELIVERED', 'CANCELLED') as order_status_is_valid
        from tidy_orders""",
    "clean_orders": one_per_key(
        "checked_orders", "order_id",
        "customer_id, order_date, order_status_code, order_channel_code, currency_code, billing_address_id, "
        "shipping_address_id, total_item_amount, total_discount_amount, total_tax_amount, "
        "total_shipping_amount, grand_total_amount, created_at, updated_at"),
    "tidy_order_item": f"""
        select order_item_id, order_id, product_variant_id, {clamp('int', 'quantity')},
               {clamp(MONEY12, 'base_unit_price', 'discount_amount', 'tax_amount', 'shipping_amount',
                      'line_total_amount')},
               created_at, updated_at, {STAMP} from raw_order_item""",
    "clean_order_item": one_per_key(
        "tidy_order_item", "order_item_id",
        "order_id, product_variant_id, quantity, base_unit_price, discount_amount, tax_amount, "
        "shipping_amount, line_total_amount, created_at, updated_at, quantity_was_negative, "
        "line_total_amount_was_negative"),
    "tidy_product": f"""
        select product_id, {text('product_name', 'short_description')}, brand_id, default_category_id,
               created_at, updated_at, is_active, {STAMP} from raw_product""",
    "clean_product": one_per_key(
        "tidy_product", "product_id", "product_name, brand_id, default_category_id, short_description, is_active"),
    "tidy_product_variant": f"""
        select product_variant_id, product_id, {text('sku', 'variant_name')}, created_at, updated_at,
               is_active, {STAMP} from raw_product_variant""",
    "clean_product_variant": one_per_key(
        "tidy_product_variant", "product_variant_id", "product_id, sku, variant_name, is_active"),
    "tidy_inventory_level": f"""
        select warehouse_id, product_variant_id, {clamp('int', 'on_hand_qty', 'reserved_qty')},
               last_updated_at, {STAMP} from raw_inventory_level""",
    "clean_inventory_level": one_per_key(
        "tidy_inventory_level", "warehouse_id, product_variant_id",
        "on_hand_qty, reserved_qty, last_updated_at, on_hand_qty_was_negative, reserved_qty_was_negative"),
    "tidy_payment": f"""
        select payment_id, order_id, {text('payment_method_code', 'payment_status_code', 'currency_code',
                                           'transaction_reference')},
               {clamp(MONEY12, 'amount')}, try_cast(payment_date as timestamp) as payment_date,
               nullif(trim(payment_status_code), '') in ('PENDING', 'SUCCESS', 'FAILED', 'REFUNDED')
                   as payment_status_is_valid,
               created_at, updated_at, {STAMP} from raw_payment""",
    "clean_payment": one_per_key("tidy_payment", "payment_id", "order_id, payment_method_code, payment_status_code, amount"),
    "tidy_refund": f"""
        select refund_id, payment_id, order_id, {clamp(MONEY12, 'refund_amount')},
               try_cast(refund_date as timestamp) as refund_date, {STAMP} from raw_refund""",
    "clean_refund": one_per_key("tidy_refund", "refund_id", "payment_id, order_id, refund_amount"),
    "tidy_product_attributes": f"""
        select {text('product_id', 'category_code', 'source_system')},
               try_cast(effective_from as timestamp) as effective_from,
               try_cast(effective_to as timestamp) as effective_to,
               attributes, {STAMP} from raw_product_attributes""",
    "clean_product_attributes": one_per_key(
        "tidy_product_attributes", "product_id, effective_from",
        "category_code, source_system, effective_to, attributes", required="product_id"),
    "tidy_product_reviews": f"""
        select {text('review_id', 'product_id', 'customer_id', 'review_title', 'review_text', 'source', 'status',
                     'moderation_notes')},
               cast(trunc(try_cast(rating as double)) as int) as parsed, helpful_votes,
               try_cast(review_date as timestamp) as review_date, metadata, {STAMP} from raw_product_reviews""",
    "clean_product_reviews": """
        select * exclude (parsed, review_text),
               case when parsed < 1 then 1 when parsed > 5 then 5 else parsed end as rating,
               parsed < 1 or parsed > 5 as rating_was_out_of_range,
               substr(review_text, 1, 5000) as review_text,
               length(review_text) > 5000 as review_text_was_truncated,
               status in ('PUBLISHED', 'PENDING', 'REJECTED') as review_status_is_valid
        from tidy_product_reviews where review_id is not null""",
    # tables without rules of their own are only trimmed, blanked and stamped
    "clean_customer_address": f"""
        select customer_address_id, customer_id, {text('address_line1', 'address_line2', 'landmark', 'city', 'state',
               'postal_code', 'country_code', 'address_type_code')}, is_default, created_at, {STAMP}
        from raw_customer_address""",
    "clean_brand": f"select brand_id, {text('brand_name')}, {STAMP} from raw_brand",
    "clean_category": f"""
        select category_id, {text('category_name')}, parent_category_id, category_level, {STAMP} from raw_category""",
    "clean_promotion": f"""
        select promotion_id, {text('promotion_code', 'promotion_name', 'discount_type')}, discount_value, start_date,
               end_date, min_order_amount, max_discount_amount, is_active, {STAMP} from raw_promotion""",
}

CTES |= {
    "aged_customer": f"""
        select *, concat_ws(' ', first_name, last_name) as full_name,
               cast(year(date_of_birth) as int) as birth_year,
               cast(floor(date_diff('day', date_of_birth, date '{AS_OF}') / 365.25::double) as bigint) as age_years,
               status_code = 'ACTIVE' as is_active_flag
        from clean_customer""",
    "enrich_customer": """
        select *, case when age_years is null then 'UNKNOWN' when age_years < 18 then 'UNDER_18'
                       when age_years between 18 and 25 then '18_25' when age_years between 26 and 35 then '26_35'
                       when age_years between 36 and 45 then '36_45' else '46_PLUS' end as age_band
        from aged_customer""",
    "enrich_customer_address": """
        select *, upper(trim(city)) as city_normalized, upper(trim(state)) as state_normalized,
               upper(trim(city)) in ('MUMBAI', 'DELHI', 'BENGALURU', 'BANGALORE', 'KOLKATA', 'CHENNAI',
                                     'HYDERABAD', 'PUNE') as is_metro_city
        from clean_customer_address""",
    "enrich_product": """
        select *, lower(trim(product_name)) as product_name_search, is_active <> 0 as is_active_flag
        from clean_product""",
    "enrich_product_variant": """
        select *, upper(trim(sku)) as sku_normalized, concat_ws('|', product_id, sku) as variant_key
        from clean_product_variant""",
    "enrich_inventory_level": """
        select *, on_hand_qty - reserved_qty as available_qty, on_hand_qty - reserved_qty <= 0 as is_out_of_stock,
               on_hand_qty - reserved_qty > 0 and on_hand_qty - reserved_qty <= 10 as is_low_stock
        from clean_inventory_level""",
    "enrich_orders": """
        select *, cast(order_date as date) as order_date_date, cast(year(order_date) as int) as order_year,
               cast(month(order_date) as int) as order_month, cast(day(order_date) as int) as order_day,
               cast(weekofyear(order_date) as int) as order_weekofyear,
               case when grand_total_amount < 2000 then 'LOW' when grand_total_amount <= 10000 then 'MEDIUM'
                    when grand_total_amount > 10000 then 'HIGH' else 'UNKNOWN' end as order_value_band,
               row_number() over by_customer as customer_order_sequence,
               row_number() over by_customer = 1 as is_first_order
        from clean_orders
        window by_customer as (partition by customer_id order by order_date asc nulls first, order_id)""",
    "priced_order_item": f"""
        select *, cast(quantity * base_unit_price as decimal(18,2)) as gross_amount from clean_order_item""",
    "enrich_order_item": """
        select *, case when gross_amount > 0 then discount_amount::double / gross_amount::double * 100.0::double
                       else 0.0::double end as effective_discount_pct,
               cast(gross_amount - discount_amount + tax_amount + shipping_amount as decimal(18,2)) as net_line_amount
        from priced_order_item""",
    "enrich_payment": """
        select *, payment_status_code = 'SUCCESS' as is_successful, payment_status_code = 'FAILED' as is_failed,
               row_number() over (partition by order_id order by payment_date asc nulls first, payment_id)
                   as payment_attempt_number
        from clean_payment""",
    "enrich_product_reviews": """
        select *, cast(length(review_text) as int) as review_length_chars,
               case when rating >= 4 then 'GOOD' when rating = 3 then 'NEUTRAL' when rating <= 2 then 'BAD'
                    else 'UNKNOWN' end as review_sentiment_label,
               helpful_votes >= 5 as is_helpful_review
        from clean_product_reviews""",
    "enrich_promotion": f"""
        select *, discount_type = 'PERCENT' as is_percentage_discount, discount_type = 'AMOUNT' as is_flat_discount,
               cast(start_date as date) as start_date_date, cast(end_date as date) as end_date_date,
               is_active <> 0 and cast(start_date as date) <= date '{AS_OF}'
                   and (end_date is null or cast(end_date as date) >= date '{AS_OF}') as is_currently_active
        from clean_promotion""",
}

CTES |= {
    "dim_date": f"""
        select distinct {date_key('order_date')} as date_key, cast(order_date as date) as date,
               cast(year(order_date) as int) as year, cast(quarter(order_date) as int) as quarter,
               cast(month(order_date) as int) as month, strftime(order_date, '%B') as month_name,
               cast(weekofyear(order_date) as int) as weekofyear, cast(day(order_date) as int) as day,
               strftime(order_date, '%a') as day_of_week
        from clean_orders where order_date is not null""",
    "home_address": """
        select * from enrich_customer_address where is_default <> 0 and address_type_code = 'HOME'
        qualify row_number() over (partition by customer_id order by created_at asc nulls first,
                                   customer_address_id) = 1""",
    "dim_customer": """
        select c.customer_id as customer_key, first_name, last_name, full_name, email, email_is_valid, phone_number,
               phone_is_valid, gender, date_of_birth, birth_year, age_years, age_band, status_code, is_active_flag,
               address_line1, address_line2, landmark, city, state, postal_code, country_code, city_normalized,
               state_normalized, is_metro_city, c.ingestion_ts
        from enrich_customer c left join home_address a on c.customer_id = a.customer_id""",
    "dim_product": """
        select product_id as product_key, product_name, product_name_search, p.brand_id, brand_name,
               default_category_id, category_name as default_category_name, parent_category_id, category_level,
               short_description, is_active, is_active_flag, created_at, updated_at, p.ingestion_ts
        from enrich_product p left join clean_brand b on p.brand_id = b.brand_id
             left join clean_category c on p.default_category_id = c.category_id""",
    "dim_product_variant": """
        select product_variant_id as product_variant_key, product_id, sku, sku_normalized, variant_name, variant_key,
               product_name, product_name_search, brand_id, brand_name, default_category_id, default_category_name,
               v.is_active, v.created_at, v.updated_at, v.ingestion_ts
        from enrich_product_variant v left join dim_product p on v.product_id = p.product_key""",
    "dim_promotion": """
        select promotion_id as promotion_key, promotion_code, promotion_name, discount_type, discount_value,
               min_order_amount, max_discount_amount, start_date, end_date, is_active, is_percentage_discount,
               is_flat_discount, is_currently_active, ingestion_ts
        from enrich_promotion""",
    "fact_orders": f"""
        select order_id, customer_id as customer_key, order_date, {date_key('order_date')} as order_date_key,
               order_status_code, order_status_is_valid, order_channel_code, currency_code, billing_address_id,
               shipping_address_id, total_item_amount, total_discount_amount, total_tax_amount,
               total_shipping_amount, grand_total_amount, order_value_band, customer_order_sequence,
               is_first_order, amount_mismatch_flag, created_at, updated_at, ingestion_ts
        from enrich_orders""",
    "fact_order_items": """
        select order_item_id, i.order_id, customer_key, product_variant_id as product_variant_key, order_date_key,
               quantity, base_unit_price, discount_amount, tax_amount, shipping_amount, gross_amount,
               effective_discount_pct, net_line_amount, i.created_at, i.updated_at, i.ingestion_ts
        from enrich_order_item i left join fact_orders o on i.order_id = o.order_id""",
    "fact_payments": """
        select payment_id, order_id, payment_method_code, payment_status_code, is_successful, is_failed,
               payment_attempt_number, amount, currency_code, transaction_reference, payment_date, created_at,
               updated_at, ingestion_ts
        from enrich_payment""",
    "fact_product_reviews": """
        select review_id, product_id, customer_id, rating, rating_was_out_of_range, review_title, review_text,
               review_length_chars, review_sentiment_label, helpful_votes, is_helpful_review, source, status,
               review_status_is_valid, review_date, metadata, ingestion_ts
        from enrich_product_reviews""",
    "gold_daily_sales_product": """
        select order_date_key, i.product_variant_key, product_id, product_name, brand_id, brand_name,
               default_category_id, default_category_name, cast(sum(quantity) as bigint) as total_quantity_sold,
               cast(sum(gross_amount) as decimal(28,2)) as total_gross_sales,
               cast(sum(discount_amount) as decimal(22,2)) as total_discount_given,
               cast(sum(tax_amount) as decimal(22,2)) as total_tax_collected,
               cast(sum(shipping_amount) as decimal(22,2)) as total_shipping_charged,
               cast(sum(net_line_amount) as decimal(28,2)) as total_net_sales,
               count(distinct order_id) as distinct_orders
        from fact_order_items i left join dim_product_variant v on i.product_variant_key = v.product_variant_key
        group by all""",
    "gold_daily_sales_customer": """
        select order_date_key, o.customer_key, age_band, is_active_flag, city_normalized, state_normalized,
               is_metro_city, count(distinct order_id) as order_count,
               cast(sum(grand_total_amount) as decimal(22,2)) as total_revenue,
               sum(grand_total_amount)::double / count(grand_total_amount) as avg_order_value,
               count(*) filter (is_first_order) as first_order_count,
               count(*) filter (not is_first_order) as repeat_order_count
        from fact_orders o left join dim_customer c on o.customer_key = c.customer_key
        group by all""",
    "gold_product_review_summary": f"""
        select product_id, {date_key('review_date')} as review_date_key, count(review_id) as total_reviews,
               avg(rating) as avg_rating, count(*) filter (rating >= 4) as positive_reviews,
               count(*) filter (rating = 3) as neutral_reviews, count(*) filter (rating <= 2) as negative_reviews,
               count(*) filter (is_helpful_review) as helpful_reviews
        from fact_product_reviews group by 1, 2""",
    "gold_payment_summary": f"""
        select {date_key('payment_date')} as payment_date_key, payment_method_code, payment_status_code,
               count(payment_id) as payment_attempts, count(*) filter (is_successful) as successful_payments,
               count(*) filter (is_failed) as failed_payments,
               cast(sum(amount) as decimal(22,2)) as total_amount,
               sum(amount)::double / count(amount) as avg_payment_amount
        from fact_payments group by 1, 2, 3""",
}


def with_ctes(body: str) -> str:
    """``body`` behind the CTEs it needs, each defined before it is used."""
    needed: dict[str, str] = {}

    def visit(sql: str) -> None:
        for word in re.findall(r"\b[a-z_]+\b", sql):
            if word in CTES and word not in needed:
                visit(CTES[word])
                needed[word] = CTES[word]

    visit(body)
    return f"with {', '.join(f'{n} as ({s})' for n, s in needed.items())} {body}" if needed else body


def layer(name: str, columns: str = "*") -> str:
    return with_ctes(f"select {columns} from {name}")


def layer_in_zone(name: str, hours: int) -> str:
    """A table whose days are cut on clocks ``hours`` ahead of UTC, and texts read there."""
    def shifted(source: str, col: str, by: int) -> str:
        return f"(select * replace ({col} + to_hours({by}) as {col}) from {source})"

    bodies = {
        "fact_orders": f"select * replace ({date_key(f'order_date + to_hours({hours})')} as order_date_key) from fact_orders",
        "fact_payments": f"select * from {shifted('fact_payments', 'payment_date', -hours)}",
    }
    sources = {"dim_date": ("clean_orders", "order_date"), "gold_payment_summary": ("fact_payments", "payment_date"),
               "gold_product_review_summary": ("fact_product_reviews", "review_date")}
    if name in sources:
        source, col = sources[name]
        bodies[name] = CTES[name].replace(f"from {source}", f"from {shifted(source, col, hours)}")
    return with_ctes(bodies[name])
