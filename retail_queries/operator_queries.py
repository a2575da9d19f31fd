"""Single operators over the given tables as they are, each with its SQL beside it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_layers.functions import dates, numbers, text
from retail_layers.operators import columns, keys, quality
from retail_layers.operators.derive import Rule, derive
from retail_layers.operators.joins import lookup_left
from retail_layers.operators.slices import order_number
from retail_layers.plans import clean, enrich, star
from retail_queries.shapes import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function name, with the SQL that has to agree with it."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLE[build.__name__] = sql
        return build
    return register


# --- generic cleaning ---------------------------------------------------------------

@query("""
    select c_custkey, case when c_acctbal < 0 then 0.0 else c_acctbal end as c_acctbal,
           coalesce(c_acctbal < 0, false) as c_acctbal_was_negative
    from customer""")
def clamp_negative_balance(spark, sf):
    return columns.clamp_negative(table(spark, sf, "customer").select("c_custkey", "c_acctbal"),
                                  ["c_acctbal", "no_such_column"])


@query("""
    select c_custkey, array_to_string(list_transform(
               string_split(c_mktsegment || ' de ' || upper(c_name) || ' o''NEIL-smith', ' '),
               lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') as full_name
    from customer""")
def title_case_names(spark, sf):
    named = table(spark, sf, "customer").select(
        "c_custkey", F.expr("concat(c_mktsegment, ' de ', upper(c_name), ' o\\'NEIL-smith')").alias("full_name"))
    return clean.normalize_names(named, ["full_name"])


@query("""
    select c_custkey, nullif(trim('  ' || c_name || chr(9) || ' '), '') as c_name,
           case when trim(case when c_mktsegment = 'BUILDING' then '   ' when c_mktsegment = 'MACHINERY' then ' NULL'
                               else c_mktsegment end) in ('', 'NULL') then null else c_mktsegment end as c_mktsegment,
           timestamp '2025-11-30 06:00:00' as ingestion_ts
    from customer""")
def trim_blank_to_null(spark, sf):
    padded = table(spark, sf, "customer").selectExpr(
        "c_custkey", "concat('  ', c_name, '\\t', ' ') as c_name",
        "case when c_mktsegment = 'BUILDING' then '   ' when c_mktsegment = 'MACHINERY' then ' NULL' "
        "else c_mktsegment end as c_mktsegment")
    return columns.generic_clean(padded, F.expr("timestamp_ntz'2025-11-30 06:00:00'"), null_tokens=["NULL"])


@query("""
    with loose as (
        select event_id, ts, event_type, trunc(try_cast(
                   case when event_type = 'error' then 'x' || json_extract_string(props, '$.k')
                        when event_type = 'click' then '99999999999'
                        when event_type = 'view' then json_extract_string(props, '$.k') || '.7'
                        else json_extract_string(props, '$.k') end as double)) as k
        from events)
    select event_id, try_cast(k as int) as k, case when event_type <> 'signup' then ts end as seen_at from loose""")
def safe_casts(spark, sf):
    loose = table(spark, sf, "events").selectExpr(
        "event_id",
        "case when event_type = 'error' then concat('x', get_json_object(props, '$.k')) "
        "when event_type = 'click' then '99999999999' "
        "when event_type = 'view' then concat(get_json_object(props, '$.k'), '.7') "
        "else get_json_object(props, '$.k') end as k",
        "case when event_type = 'signup' then '2024-13-45 99:99' else cast(ts as string) end as seen_at")
    return columns.cast_timestamps(columns.cast_integers(loose, "k"), "seen_at")


@query("""
    select s_suppkey as s_key, s_name as supplier_name, s_nationkey as nation_key, s_acctbal as balance from supplier""")
def standardize_names(spark, sf):
    untidy = table(spark, sf, "supplier").toDF(" S Key", "Supplier Name ", "NATION key", "balance")
    return columns.standardize_names(untidy)


LINE_COLUMNS = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate")


@query(f"""
    select * from lineitem where l_orderkey is not null and l_linenumber is not null
    qualify row_number() over (partition by l_orderkey, l_linenumber
                               order by {', '.join(f'{c} asc nulls last' for c in LINE_COLUMNS)}) = 1""")
def dedup_by_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    return keys.dedup(keys.require_keys(lines, ["l_orderkey", "l_linenumber"]), ["l_orderkey", "l_linenumber"])


@query("""
    select l_suppkey, l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_partkey from lineitem
    qualify row_number() over (partition by l_returnflag order by l_shipdate asc nulls first, l_orderkey,
                               l_linenumber, l_partkey, l_suppkey) = 1""")
def dedup_few_keys(spark, sf):
    """Three keys for the whole table: almost every row is a copy of one of them."""
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_shipdate", "l_orderkey",
                                                "l_linenumber", "l_partkey")
    order = [F.col(c).asc_nulls_first() for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return keys.dedup(lines, ["l_returnflag"], order)


@query("""
    select event_id, value < 10 or value > 400 as was_outside,
           case when value < 10 then 10.0 when value > 400 then 400.0 else value end as value
    from events""")
def clip_range(spark, sf):
    flagged = table(spark, sf, "events").select(
        "event_id", numbers.outside(F.col("value"), 10, 400).alias("was_outside"), "value")
    return columns.clip_range(flagged, "value", 10, 400)


# --- domain cleaning ------------------------------------------------------------------

EMAIL_SQL = r"'^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$'"


@query(f"""
    select doc_id, lower(trim(contact)) as contact, regexp_matches(lower(trim(contact)), {EMAIL_SQL}) as contact_is_valid,
           regexp_matches(lower(trim(text)), {EMAIL_SQL}) as text_is_valid
    from (select doc_id, text, case lang when 'en' then ' ' || source || '@Shop.COM ' when 'de' then source || '@shop'
                                         when 'fr' then source || '@shop.com' || chr(10) else null end as contact
          from documents)""")
def email_flag(spark, sf):
    contacts = table(spark, sf, "documents").selectExpr(
        "doc_id", "text", "case lang when 'en' then concat(' ', source, '@Shop.COM ') when 'de' then concat(source, '@shop') "
        "when 'fr' then concat(source, '@shop.com', '\\n') end as contact")
    return clean.clean_email(clean.clean_email(contacts, "contact"), "text").drop("text")


@query("""
    select doc_id, regexp_replace(phone, '\\s+', '', 'g') as phone,
           length(regexp_replace(phone, '\\D', '', 'g')) >= 6 as phone_is_valid,
           length(regexp_replace(text, '\\D', '', 'g')) >= 6 as text_has_digits
    from (select doc_id, text, case lang when 'es' then null else '+ ' || doc_id || ' ' || n_chars || ' ' end as phone
          from documents)""")
def phone_flag(spark, sf):
    phones = table(spark, sf, "documents").selectExpr(
        "doc_id", "text", "case lang when 'es' then null else concat('+ ', doc_id, ' ', n_chars, ' ') end as phone")
    flagged = clean.clean_phone(phones, "phone", "phone_is_valid")
    return clean.clean_phone(flagged, "text", "text_has_digits").drop("text")


@query("""
    select doc_id, substr(trim('  ' || text || ' '), 1, 5000) as text,
           length(trim('  ' || text || ' ')) > 5000 as text_was_truncated,
           cast(length(substr(trim('  ' || text || ' '), 1, 5000)) as int) as text_length
    from documents""")
def truncate_text(spark, sf):
    padded = table(spark, sf, "documents").selectExpr("doc_id", "concat('  ', text, ' ') as text")
    return clean.limit_text(padded, "text").withColumn("text_length", F.length("text"))


@query("""
    select o_orderkey, nullif(o_orderstatus, 'P') as status, nullif(o_orderstatus, 'P') in ('F', 'X') as status_is_valid
    from orders""")
def domain_flag(spark, sf):
    coded = table(spark, sf, "orders").selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') as status")
    return columns.flag_in_set(coded, "status", ["F", "X"], "status_is_valid")


@query("""
    select event_id, event_type, event_type in ('view', 'click', 'purchase') as event_type_is_valid from events""")
def event_domain_flag(spark, sf):
    return columns.flag_in_set(table(spark, sf, "events").select("event_id", "event_type"), "event_type",
                               ["view", "click", "purchase"], "event_type_is_valid")


@query("""
    with lines as (
        select l_orderkey, sum(cast(l_extendedprice as decimal(12,2))) as items,
               sum(cast(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)) as decimal(12,2))) as discount,
               sum(cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as decimal(12,2))) as tax,
               sum(cast(case when l_linestatus = 'F' then 1.25 end as decimal(12,2))) as shipping
        from lineitem group by 1)
    select o_orderkey, abs(cast(o_totalprice as decimal(12,2)) - (items - discount + tax + shipping)) > 0.01
               as amount_mismatch_flag
    from orders left join lines on o_orderkey = l_orderkey""")
def total_mismatch(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(price).alias("items"),
        F.sum((price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(12,2)")).alias("discount"),
        F.sum((price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(12,2)")).alias("tax"),
        F.sum(F.when(F.col("l_linestatus") == "F", F.lit(Decimal("1.25"))).cast("decimal(12,2)")).alias("shipping"))
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("total"))
    joined = lookup_left(orders, lines, "o_orderkey", ["items", "discount", "tax", "shipping"], dim_on="l_orderkey")
    return clean.flag_total_mismatch(joined, "total", ("items", "tax", "shipping"), ("discount",)).select(
        "o_orderkey", "amount_mismatch_flag")


@query("""
    select p_partkey, nullif(trim(case when p_type = 'SMALL' then '  ' else ' ' || p_name end), '') as product_name,
           lower(trim(nullif(trim(case when p_type = 'SMALL' then '  ' else ' ' || p_name end), ''))) as product_name_search,
           trim(case when p_type <> 'PROMO' then ' ' || p_brand || ' ' end) as sku,
           upper(trim(case when p_type <> 'PROMO' then ' ' || p_brand || ' ' end)) as sku_normalized,
           concat_ws('|', p_partkey, trim(case when p_type <> 'PROMO' then ' ' || p_brand || ' ' end)) as variant_key
    from part""")
def product_and_sku_text(spark, sf):
    parts = table(spark, sf, "part").selectExpr(
        "p_partkey", "p_partkey as product_id",
        "case when p_type = 'SMALL' then '  ' else concat(' ', p_name) end as product_name",
        "case when p_type <> 'PROMO' then concat(' ', p_brand, ' ') end as sku")
    tidy = clean.trim_columns(clean.normalize_product_name(parts), ["sku"])
    return derive(tidy, *enrich.product_rules(), *enrich.variant_rules()).drop("product_id")


# --- enrichment ---------------------------------------------------------------------

@query("""
    with aged as (
        select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as date_of_birth,
               o_orderstatus = 'F' as is_active_flag, concat_ws(' ', o_orderstatus, o_orderpriority) as full_name
        from orders),
    years as (
        select *, cast(year(date_of_birth) as int) as birth_year,
               cast(floor(date_diff('day', date_of_birth, date '2040-03-01') / 365.25::double) as bigint) as age_years
        from aged)
    select *, case when age_years is null then 'UNKNOWN' when age_years < 18 then 'UNDER_18' when age_years <= 25 then '18_25'
                   when age_years <= 35 then '26_35' when age_years <= 45 then '36_45' else '46_PLUS' end as age_band
    from years""")
def age_bands(spark, sf):
    people = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as date_of_birth",
        "case when o_orderstatus = 'F' then 'ACTIVE' else 'GONE' end as status_code",
        "o_orderstatus as first_name", "o_orderpriority as last_name")
    return derive(people, *enrich.customer_rules(date(2040, 3, 1))).drop("status_code", "first_name", "last_name")


@query("""
    select c_custkey, upper(trim(n_name)) as city_normalized, upper(trim(r_name)) as state_normalized,
           upper(trim(n_name)) in ('NATION_1', 'NATION_7', 'NATION_20') as is_metro_city
    from customer left join nation on c_nationkey = n_nationkey
         left join (select * from region where r_name <> 'ASIA') r on n_regionkey = r_regionkey""")
def geo_flags(spark, sf):
    cities = lookup_left(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), table(spark, sf, "nation"),
                         "c_nationkey", {"n_name": "city", "n_regionkey": "region"}, dim_on="n_nationkey")
    some_regions = table(spark, sf, "region").where(F.col("r_name") != "ASIA")
    places = lookup_left(cities, some_regions, "region", {"r_name": "state"}, dim_on="r_regionkey")
    return derive(places, *enrich.address_rules(("NATION_1", "NATION_7", "NATION_20"))).select(
        "c_custkey", "city_normalized", "state_normalized", "is_metro_city")


@query("""
    with stock as (
        select p_partkey, p_retailprice > 950 as is_active_flag, p_size - 20 < 0 as on_hand_qty_was_negative,
               case when p_size < 20 then 0 else p_size - 20 end as on_hand_qty, cast(5 as int) as reserved_qty
        from part)
    select *, on_hand_qty - reserved_qty as available_qty, on_hand_qty - reserved_qty <= 0 as is_out_of_stock,
           on_hand_qty - reserved_qty between 1 and 10 as is_low_stock
    from stock""")
def stock_flags(spark, sf):
    stock = table(spark, sf, "part").selectExpr("p_partkey", "int(p_retailprice > 950) as is_active",
                                                "p_size - 20 as on_hand_qty", "5 as reserved_qty")
    clamped = columns.clamp_negative(stock, ["on_hand_qty"])
    return derive(clamped, *enrich.stock_rules(), enrich.product_rules()[1]).drop("is_active")


@query("""
    select o_orderkey, cast(o_orderdate as date) as order_date_date, cast(year(o_orderdate) as int) as order_year,
           cast(month(o_orderdate) as int) as order_month, cast(day(o_orderdate) as int) as order_day,
           cast(weekofyear(o_orderdate) as int) as order_weekofyear
    from orders""")
def order_date_parts(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("order_date"))
    return derive(orders, *enrich.order_rules()).drop("order_date")


@query("""
    select event_id, cast(ts + interval 330 minute as date) as order_date_date,
           cast(year(ts + interval 330 minute) as int) as order_year, cast(month(ts + interval 330 minute) as int) as order_month,
           cast(day(ts + interval 330 minute) as int) as order_day,
           cast(weekofyear(ts + interval 330 minute) as int) as order_weekofyear
    from events""")
def order_date_parts_in_zone(spark, sf):
    """Instants, cut into days as clocks in India show them."""
    seen = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("order_date"))
    return derive(seen, *enrich.order_rules(columns.wall_clocks(seen, "Asia/Kolkata"))).drop("order_date")


@query("""
    select event_id, case when event_type <> 'signup' then ts - interval 330 minute end as seen_at from events""")
def timestamps_read_in_zone(spark, sf):
    """Text with an offset (clicks) and without one, the latter read as clocks in India show it."""
    loose = table(spark, sf, "events").selectExpr(
        "event_id",
        "case when event_type = 'signup' then '2024-13-45 99:99' "
        "when event_type = 'click' then concat(cast(ts - interval 330 minutes as string), '+00:00') "
        "else cast(ts as string) end as seen_at")
    return columns.cast_timestamps(loose, "seen_at", zone="Asia/Kolkata")


@query("""
    select o_orderkey, case when price is null then 'UNKNOWN' when price < 2000 then 'LOW' when price <= 10000 then 'MEDIUM'
                            else 'HIGH' end as order_value_band
    from (select o_orderkey, case when o_orderpriority <> '5-LOW' then cast(o_totalprice as decimal(12,2)) end as price
          from orders)""")
def value_band(spark, sf):
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderpriority <> '5-LOW' then cast(o_totalprice as decimal(12,2)) end as grand_total_amount")
    return derive(orders, *enrich.order_rules()).drop("grand_total_amount")


@query("""
    with priced as (
        select l_orderkey, l_linenumber, cast(l_quantity as int) as quantity, cast(l_extendedprice as decimal(12,2)) as base_unit_price,
               cast(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)) as decimal(12,2)) as discount_amount,
               cast(l_tax * 100 as decimal(12,2)) as tax_amount, cast(case when l_linestatus = 'F' then 3 end as decimal(12,2)) as shipping_amount
        from lineitem),
    gross as (
        select *, cast(case when quantity > 5 then quantity when quantity > 2 then 0 end * base_unit_price as decimal(18,2)) as gross_amount
        from priced)
    select l_orderkey, l_linenumber, gross_amount,
           case when gross_amount > 0 then discount_amount::double / gross_amount::double * 100.0::double else 0.0::double end
               as effective_discount_pct,
           cast(gross_amount - discount_amount + tax_amount + shipping_amount as decimal(18,2)) as net_line_amount
    from gross""")
def line_amounts(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "case when l_quantity > 5 then int(l_quantity) when l_quantity > 2 then 0 end as quantity",
        "cast(l_extendedprice as decimal(12,2)) as base_unit_price",
        "cast(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)) as decimal(12,2)) as discount_amount",
        "cast(l_tax * 100 as decimal(12,2)) as tax_amount",
        "cast(case when l_linestatus = 'F' then 3 end as decimal(12,2)) as shipping_amount")
    return derive(lines, *enrich.line_rules()).select(
        "l_orderkey", "l_linenumber", "gross_amount", "effective_discount_pct", "net_line_amount")


@query("""
    select event_id, status = 'SUCCESS' as is_successful, status = 'FAILED' as is_failed
    from (select event_id, case event_type when 'purchase' then 'SUCCESS' when 'error' then 'FAILED'
                                           when 'view' then 'PENDING' end as status from events)""")
def payment_flags(spark, sf):
    payments = table(spark, sf, "events").selectExpr(
        "event_id", "case event_type when 'purchase' then 'SUCCESS' when 'error' then 'FAILED' "
        "when 'view' then 'PENDING' end as payment_status_code")
    return derive(payments, *enrich.payment_rules()).drop("payment_status_code")


@query("""
    select doc_id, cast(length(text) as int) as review_length_chars,
           case when quality is null then 'UNKNOWN' when quality * 2 + toxic + 2 >= 4 then 'GOOD'
                when quality * 2 + toxic + 2 = 3 then 'NEUTRAL' else 'BAD' end as review_sentiment_label,
           quality * 4 + toxic >= 5 as is_helpful_review
    from documents left join labels using (doc_id)""")
def review_labels(spark, sf):
    labelled = lookup_left(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels"),
                           "doc_id", ["quality", "toxic"])
    reviews = labelled.selectExpr("doc_id", "text as review_text", "quality * 2 + toxic + 2 as rating",
                                  "quality * 4 + toxic as helpful_votes")
    return derive(reviews, *enrich.review_rules()).select(
        "doc_id", "review_length_chars", "review_sentiment_label", "is_helpful_review")


@query("""
    select o_orderkey, kind = 'PERCENT' as is_percentage_discount, kind = 'AMOUNT' as is_flat_discount, start_date_date,
           end_date_date, is_active and start_date_date <= date '1998-06-15'
               and (end_date_date is null or end_date_date >= date '1998-06-15') as is_currently_active
    from (select o_orderkey, case o_orderstatus when 'F' then 'PERCENT' when 'O' then 'AMOUNT' end as kind,
                 cast(o_orderdate as date) as start_date_date, o_totalprice > 50000 as is_active,
                 case when o_orderpriority <> '1-URGENT' then cast(o_orderdate as date) + 365 end as end_date_date
          from orders)""")
def validity_interval(spark, sf):
    offers = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "case o_orderstatus when 'F' then 'PERCENT' when 'O' then 'AMOUNT' end as discount_type",
        "o_orderdate as start_date", "int(o_totalprice > 50000) as is_active",
        "case when o_orderpriority <> '1-URGENT' then date_add(cast(o_orderdate as date), 365) end as end_date")
    return derive(offers, *enrich.promotion_rules(date(1998, 6, 15))).drop(
        "discount_type", "start_date", "end_date", "is_active")


# --- windows ------------------------------------------------------------------------

def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.expr("case when o_orderpriority <> '1-URGENT' then o_orderdate end").alias("order_date"))


SEQUENCE_SQL = """
    select o_orderkey as order_id, o_custkey as customer_id,
           case when o_orderpriority <> '1-URGENT' then o_orderdate end as order_date,
           row_number() over w as customer_order_sequence, row_number() over w = 1 as is_first_order
    from orders
    window w as (partition by o_custkey order by case when o_orderpriority <> '1-URGENT' then o_orderdate end
                 asc nulls first, o_orderkey)"""


@query("""
    select source, lang, n_chars, text from documents
    qualify row_number() over (partition by source, lang order by n_chars asc nulls last, md5(text) asc nulls last) = 1""")
def dedup_long_texts(spark, sf):
    """Texts decide last and by their digest."""
    return keys.dedup(table(spark, sf, "documents").select("source", "lang", "n_chars", "text"), ["source", "lang"], long=["text"])


@query(SEQUENCE_SQL)
def order_sequence(spark, sf):
    return enrich.number_orders(_orders(spark, sf))


@query(SEQUENCE_SQL)
def order_sequence_split(spark, sf):
    """The same numbers with the least limit that counts: slices hold a thousand rows at least."""
    return enrich.number_orders(_orders(spark, sf), max_group_rows=10)


@query("""
    select event_id, user_id, ts, row_number() over (partition by user_id order by ts asc nulls first, event_id)
               as payment_attempt_number
    from events""")
def attempt_number(spark, sf):
    payments = table(spark, sf, "events").select(
        F.col("event_id").alias("payment_id"), F.col("user_id").alias("order_id"), F.col("ts").alias("payment_date"))
    return enrich.number_payments(payments).withColumnsRenamed(
        {"payment_id": "event_id", "order_id": "user_id", "payment_date": "ts"})


@query("""
    select event_id, event_type, ts, row_number() over (partition by event_type order by ts asc nulls first, event_id)
               as place
    from events""")
def sequence_few_groups(spark, sf):
    """Five groups for the whole table, each cut into slices so none meets in one task."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return keys.sequence(events, ["event_type"], [F.col("ts").asc_nulls_first(), F.col("event_id").asc_nulls_first()],
                         "place", max_group_rows=100, slice_on=[order_number(events, "ts"), order_number(events, "event_id")])


@query("""
    select o_orderkey, if(o_custkey % 3 = 0, 0, o_custkey) as o_custkey, o_orderdate,
           row_number() over (partition by if(o_custkey % 3 = 0, 0, o_custkey) order by o_orderdate asc nulls first, o_orderkey) as place
    from orders""")
def order_sequence_hot_customer(spark, sf):
    """A third of all orders under one customer, and every day's orders alike."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 3 == 0, 0).otherwise(F.col("o_custkey")).alias("o_custkey"), "o_orderdate")
    return keys.sequence(orders, ["o_custkey"], [F.col("o_orderdate").asc_nulls_first(), F.col("o_orderkey").asc()], "place",
                         max_group_rows=1000, slice_on=[order_number(orders, "o_orderdate"), order_number(orders, "o_orderkey")])


@query("""
    select o_orderkey, o_custkey, o_orderdate, o_totalprice from orders
    where o_orderstatus = 'F' and o_totalprice > 100000
    qualify row_number() over (partition by o_custkey order by o_orderdate asc nulls first, o_orderkey) = 1""")
def first_row_per_group(spark, sf):
    addresses = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("customer_address_id"),
        F.col("o_orderdate").alias("created_at"), "o_totalprice",
        F.expr("int(o_totalprice > 100000)").alias("is_default"), F.col("o_orderstatus").alias("address_type_code"))
    return star.default_address(addresses, "F").select(
        F.col("customer_address_id").alias("o_orderkey"), F.col("customer_id").alias("o_custkey"),
        F.col("created_at").alias("o_orderdate"), "o_totalprice")


@query("""
    select distinct cast(strftime(ts, '%Y%m%d') as int) as date_key, cast(ts as date) as day, event_type
    from events where ts is not null""")
def distinct_days(spark, sf):
    seen = table(spark, sf, "events").where(F.col("ts").isNotNull())
    return seen.select(dates.date_key(F.col("ts")).alias("date_key"), F.to_date("ts").alias("day"), "event_type").distinct()


# --- integrity ----------------------------------------------------------------------

@query("""
    select l_orderkey, l_linenumber, count(*) as row_count from lineitem group by 1, 2 having count(*) > 1""")
def pk_violations(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    select o_custkey, count(*) as row_count from orders
    where o_custkey is not null and o_custkey not in (select c_custkey from customer where c_acctbal >= 0) group by 1""")
def fk_orphans(spark, sf):
    solvent = table(spark, sf, "customer").where("c_acctbal >= 0")
    return quality.orphans(table(spark, sf, "orders"), ["o_custkey"], solvent, ["c_custkey"])


@query("""
    select c.parent as parent, count(*) as row_count
    from (select n_nationkey, case when n_regionkey > 0 then n_regionkey * 7 end as parent from nation) c
    where c.parent is not null and not exists (select 1 from nation p where p.n_nationkey = c.parent) group by 1""")
def self_reference_orphans(spark, sf):
    nodes = table(spark, sf, "nation").selectExpr(
        "n_nationkey", "case when n_regionkey > 0 then n_regionkey * 7 end as parent")
    return quality.orphans(nodes, ["parent"], nodes, ["n_nationkey"])


NULLABLE = {"name": "nullif(c_mktsegment, 'BUILDING')", "balance": "case when c_acctbal >= 0 then c_acctbal end",
            "c_custkey": "c_custkey"}


@query(" union all ".join(
    f"select '{name}' as column_name, count(*) - count({expr}) as null_rows from customer"
    for name, expr in NULLABLE.items()))
def null_report(spark, sf):
    holes = table(spark, sf, "customer").selectExpr(*[f"{expr} as {name}" for name, expr in NULLABLE.items()])
    return quality.null_counts(holes, list(NULLABLE))


# --- text helpers used by several tables ----------------------------------------------

@query("""
    select doc_id, lower(trim(text)) as search_text, cast(length(trim(text)) as int) as trimmed_chars
    from documents""")
def search_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return derive(docs, Rule("search_text", ("text",), lambda: text.lower_trimmed(F.col("text"))),
                  Rule("trimmed_chars", ("text",), lambda: F.length(text.trimmed(F.col("text"))))).drop("text")
