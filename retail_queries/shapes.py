"""Retail-shaped source tables derived from the given tables, in Spark and in SQL.

The given tables are clean, so the derivations also plant what cleaning has to deal with:
padding, blanks, unknown codes, negative amounts, unparsable text, missing keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# name: (given table, {column: (Spark SQL, DuckDB SQL or None when it is the same)})
MONEY = "cast({0} as decimal(12,2))"
CREATED = ("timestamp_ntz'2025-01-01 00:00:00'", "timestamp '2025-01-01 00:00:00'")
PRICE = "cast(o_totalprice as decimal(12,2))"
DISCOUNT = (f"case when o_orderpriority = '5-LOW' then cast(-5 as decimal(12,2)) "
            f"else cast({PRICE} * cast(0.05 as decimal(3,2)) as decimal(12,2)) end")
TAX = (f"case when o_orderstatus = 'O' and o_orderpriority = '4-NOT SPECIFIED' then null "
       f"else cast({PRICE} * cast(0.08 as decimal(3,2)) as decimal(12,2)) end")
EVENT_TIME = ("case when event_type = 'signup' and value < 20 then 'not a date' else cast(ts as string) end",
              "case when event_type = 'signup' and value < 20 then 'not a date' else cast(ts as varchar) end")

SHAPES: dict[str, tuple[str, dict[str, str | tuple[str, str]]]] = {
    "customer": ("customer", {
        "customer_id": "c_custkey",
        "first_name": "case when c_mktsegment = 'FURNITURE' then '   ' else concat('  ', c_mktsegment, ' mc') end",
        "last_name": "concat(c_name, ' ')",
        "email": ("case when c_mktsegment = 'BUILDING' then null when c_acctbal < 0 then concat(c_name, ' at home') "
                  "else concat(' ', replace(c_name, '#', '.'), '@', c_mktsegment, '.Com ') end"),
        "phone_number": ("case when c_nationkey < 3 then 'n/a 12' when c_nationkey = 3 then null "
                         "else concat('+91 ', c_custkey + 9000000000) end"),
        "date_of_birth": ("case when c_acctbal < 0 then null "
                          "else date_add(date'1955-01-01', cast(floor(c_acctbal * 2) as int)) end",
                          "case when c_acctbal < 0 then null "
                          "else date '1955-01-01' + cast(floor(c_acctbal * 2) as int) end"),
        "gender": "case when c_nationkey < 12 then 'F' when c_nationkey < 23 then 'M' end",
        "status_code": ("case when c_nationkey < 10 then 'ACTIVE' when c_nationkey < 18 then 'INACTIVE' "
                        "when c_nationkey < 21 then 'BLOCKED' when c_nationkey < 23 then 'GUEST' "
                        "when c_nationkey = 23 then '' end"),
    }),
    "customer_address": ("orders", {
        "customer_address_id": "o_orderkey",
        "customer_id": "o_custkey",
        "address_line1": "concat(o_orderpriority, ' street')",
        "address_line2": ("cast(null as string)", "cast(null as varchar)"),
        "landmark": "' '",
        "city": ("case o_orderpriority when '1-URGENT' then ' Mumbai' when '2-HIGH' then 'pune ' "
                 "when '3-MEDIUM' then 'Nashik' when '4-NOT SPECIFIED' then '' else 'Delhi' end"),
        "state": ("case o_orderstatus when 'F' then 'maharashtra ' when 'O' then 'Karnataka' else 'delhi' end"),
        "postal_code": ("cast(o_orderkey as string)", "cast(o_orderkey as varchar)"),
        "country_code": "'IN'",
        "address_type_code": "case when o_orderstatus = 'F' then 'HOME' when o_orderstatus = 'O' then 'OFFICE' end",
        "is_default": "cast(o_totalprice > 100000 as int)",
        "created_at": "o_orderdate",
    }),
    "brand": ("nation", {"brand_id": "n_nationkey", "brand_name": "concat(' ', n_name)"}),
    "category": ("nation", {
        "category_id": "n_nationkey",
        "category_name": "lower(n_name)",
        "parent_category_id": "n_regionkey",
        "category_level": "case when n_regionkey = 0 then 1 else 2 end",
    }),
    "product": ("supplier", {
        "product_id": "s_suppkey",
        "product_name": "case when s_acctbal < 500 then '  ' else concat('  ', s_name, ' ') end",
        "brand_id": "s_nationkey",
        "default_category_id": "cast(floor(s_acctbal / 400) as int)",
        "short_description": ("cast(null as string)", "cast(null as varchar)"),
        "created_at": CREATED,
        "updated_at": CREATED,
        "is_active": "cast(s_acctbal >= 2000 as int)",
    }),
    "product_variant": ("part", {
        "product_variant_id": "p_partkey",
        "product_id": "cast(p_size as bigint)",
        "sku": "case when p_type <> 'PROMO' then concat(' ', lower(p_brand), '-', p_partkey, ' ') end",
        "variant_name": "concat(p_type, ' / ', p_name, ' ')",
        "created_at": CREATED,
        "updated_at": CREATED,
        "is_active": "cast(p_retailprice > 950 as int)",
    }),
    "promotion": ("part", {
        "promotion_id": "p_partkey",
        "promotion_code": "concat(p_brand, '-', p_type)",
        "promotion_name": "p_name",
        "discount_type": ("case when p_type = 'ECONOMY' then 'PERCENT' when p_type in ('SMALL', 'LARGE') then 'AMOUNT' "
                          "when p_type = 'MEDIUM' then null else 'BOGO' end"),
        "discount_value": "cast(p_retailprice as decimal(10,2))",
        "start_date": ("cast(date_add(date'2025-06-01', p_size * 5) as timestamp_ntz)",
                       "cast(date '2025-06-01' + p_size * 5 as timestamp)"),
        "end_date": ("case when p_type <> 'STANDARD' then cast(date_add(date'2025-07-01', p_size * 5) as timestamp_ntz) end",
                     "case when p_type <> 'STANDARD' then cast(date '2025-07-01' + p_size * 5 as timestamp) end"),
        "min_order_amount": "cast(p_size as decimal(10,2))",
        "max_discount_amount": "cast(null as decimal(10,2))",
        "is_active": "cast(p_size > 10 as int)",
    }),
    "orders": ("orders", {
        "order_id": "case when o_totalprice >= 2000 then o_orderkey end",
        "customer_id": "o_custkey",
        "order_date": "case when o_orderpriority = '2-HIGH' and o_totalprice < 50000 then null else o_orderdate end",
        "order_status_code": ("case when o_orderstatus = 'F' then 'DELIVERED' when o_orderstatus = 'P' then ' PAID ' "
                              "when o_orderpriority = '3-MEDIUM' then '' else 'OPEN' end"),
        "order_channel_code": "'WEB'",
        "currency_code": "'INR'",
        "billing_address_id": "o_orderkey",
        "shipping_address_id": "o_orderkey",
        "total_item_amount": PRICE,
        "total_discount_amount": DISCOUNT,
        "total_tax_amount": TAX,
        "total_shipping_amount": "cast(100 as decimal(12,2))",
        "grand_total_amount": (f"case when o_orderpriority = '1-URGENT' then {PRICE} else "
                               f"cast({PRICE} - ({DISCOUNT}) + coalesce({TAX}, 0) + 100 as decimal(12,2)) end"),
        "created_at": "o_orderdate",
        "updated_at": "o_orderdate",
    }),
    "order_item": ("lineitem", {
        "order_item_id": "l_orderkey * 10 + l_linenumber",
        "order_id": "l_orderkey",
        "product_variant_id": "l_partkey",
        "quantity": "cast(case when l_returnflag = 'R' and l_linenumber = 7 then -l_quantity else l_quantity end as int)",
        "base_unit_price": MONEY.format("l_extendedprice"),
        "discount_amount": "cast(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)) as decimal(12,2))",
        "tax_amount": "cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as decimal(12,2))",
        "shipping_amount": "case when l_linestatus = 'F' then cast(10.5 as decimal(12,2)) end",
        "line_total_amount": "cast(case when l_returnflag = 'A' then -l_extendedprice else l_extendedprice end as decimal(12,2))",
        "created_at": "l_shipdate",
        "updated_at": "l_shipdate",
    }),
    "inventory_level": ("lineitem", {
        "warehouse_id": "l_suppkey",
        "product_variant_id": "l_partkey",
        "on_hand_qty": "cast(l_quantity as int) - 5",
        "reserved_qty": "l_linenumber - 2",
        "last_updated_at": "l_shipdate",
    }),
    "payment": ("events", {
        "payment_id": "event_id",
        "order_id": "user_id",
        "payment_method_code": "case event_type when 'view' then ' UPI' when 'click' then 'CARD' else 'COD' end",
        "payment_status_code": ("case event_type when 'purchase' then 'SUCCESS' when 'error' then 'FAILED' "
                                "when 'view' then 'PENDING ' when 'click' then 'UNKNOWN' end"),
        "amount": "cast(case when event_type = 'click' and value > 100 then -value else value end as decimal(12,2))",
        "currency_code": "'INR'",
        "transaction_reference": "props",
        "payment_date": EVENT_TIME,
        "created_at": "ts",
        "updated_at": "ts",
    }),
    "refund": ("events", {
        "refund_id": "event_id",
        "payment_id": "event_id",
        "order_id": "user_id",
        "refund_amount": "cast(cast(value as decimal(12,2)) - 20 as decimal(12,2))",
        "refund_date": EVENT_TIME,
    }),
    "product_attributes": ("events", {
        "product_id": ("case when value >= 1 then cast(user_id as string) end",
                       "case when value >= 1 then cast(user_id as varchar) end"),
        "category_code": "event_type",
        "source_system": "' CATALOG '",
        "effective_from": ("case when event_type = 'error' then 'soon' "
                           "else concat(cast(cast(ts as date) as string), 'T00:00:00Z') end",
                           "case when event_type = 'error' then 'soon' "
                           "else concat(cast(cast(ts as date) as varchar), 'T00:00:00Z') end"),
        "effective_to": ("cast(null as string)", "cast(null as varchar)"),
        "attributes": ("parse_json(props)", "props"),
    }),
    "product_reviews": ("documents", {
        "review_id": "concat('R', doc_id)",
        "product_id": "source",
        "customer_id": ("cast(doc_id as string)", "cast(doc_id as varchar)"),
        "rating": ("case when toxic = 1 then 'bad' "
                   "else concat(cast(floor(cast(n_chars as double) / 1000) as int), '.7') end"),
        "review_title": "lang",
        "review_text": "concat('  ', text, ' ')",
        "review_date": ("concat(cast(date_add(date'2024-01-01', cast(floor(cast(n_chars as double) / 50) as int)) as string), 'T09:30:00Z')",
                        "concat(cast(date '2024-01-01' + cast(floor(cast(n_chars as double) / 50) as int) as varchar), 'T09:30:00Z')"),
        "helpful_votes": "quality * 6 + toxic",
        "source": "concat(source, ' ')",
        "status": "case lang when 'en' then 'PUBLISHED' when 'de' then 'PENDING' when 'fr' then ' REJECTED' else 'DRAFT' end",
        "moderation_notes": "''",
        "metadata": ("named_struct('lang', lang, 'source', source)", "{'lang': lang, 'source': source}"),
    }),
}


def raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The retail-shaped table ``name``."""
    given, columns = SHAPES[name]
    df = table(spark, sf, given)
    if name == "product_reviews":
        df = df.join(table(spark, sf, "labels"), "doc_id", "left")
    picked = {out: sql if isinstance(sql, str) else sql[0] for out, sql in columns.items()}
    return df.select(*[F.expr(sql).alias(out) for out, sql in picked.items()])


def raw_sql(name: str) -> str:
    """The same table for DuckDB."""
    given, columns = SHAPES[name]
    picked = {out: sql if isinstance(sql, str) else sql[1] for out, sql in columns.items()}
    source = "documents left join labels using (doc_id)" if name == "product_reviews" else given
    return "select " + ", ".join(f"{sql} as {out}" for out, sql in picked.items()) + f" from {source}"
