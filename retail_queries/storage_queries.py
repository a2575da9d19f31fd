"""Upserts, and sources and sinks by round trips: each writes whole given tables and reads them back."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_layers.operators import upsert as merging
from retail_layers.operators.joins import lookup_left
from retail_layers.plans import layers
from retail_layers.scratch import scratch_path
from retail_layers.sinks import writers
from retail_layers.sinks.versioned import KeyedTable
from retail_layers.sources import readers
from retail_queries.layer_queries import (
    AS_OF_DATE,
    FLAT_METADATA_SQL,
    MART_SOURCES,
    SOURCES,
    cleaned,
    flat_metadata,
    run_time,
)
from retail_queries.layer_sql import layer, with_ctes
from retail_queries.shapes import SHAPES, raw, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
         "embeddings", "pages", "benchmark", "labels", "conversations")

FEEDS = ("product_reviews", "product_attributes")

# --- upsert: orders as the base; one batch with new, changed, stale, moved and repeated keys ---

BATCH = (
    # changed later; large ones also move to another partition
    ("o_orderkey", "'UPDATED'", "o_orderdate + interval 2 days",
     "case when o_totalprice > 300000 then '1-URGENT' else o_orderpriority end", "o_orderstatus = 'P'"),
    # the same keys once more in the same batch, earlier
    ("o_orderkey", "'REPEATED'", "o_orderdate + interval 1 day", "o_orderpriority", "o_orderstatus = 'P'"),
    # older than what is held, or without a time
    ("o_orderkey", "'STALE'", "case when o_totalprice > 200000 then o_orderdate - interval 1 day end",
     "o_orderpriority", "o_orderstatus = 'F'"),
    # new keys, one partition of them new as well
    ("o_orderkey + 10000000000", "'NEW'", "o_orderdate",
     "case when o_totalprice > 400000 then '6-LATER' else o_orderpriority end", "o_orderstatus = 'O'"),
)


def base_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as order_id", "o_custkey as customer_id", "cast(o_totalprice as decimal(12,2)) as amount",
        "o_orderstatus as status", "o_orderdate as update_ts", "o_orderpriority as order_group")


def batch_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    parts = [
        orders.where(where).selectExpr(
            f"{key} as order_id", "o_custkey as customer_id", "cast(o_totalprice + 1 as decimal(12,2)) as amount",
            f"{status} as status", f"{ts} as update_ts", f"{group} as order_group")
        for key, status, ts, group, where in BATCH
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


UPSERT_CTES = (
    "base as (select o_orderkey as order_id, o_custkey as customer_id, cast(o_totalprice as decimal(12,2)) as amount, "
    "o_orderstatus as status, o_orderdate as update_ts, o_orderpriority as order_group from orders), "
    "batch as (" + " union all ".join(
        f"select {key} as order_id, o_custkey as customer_id, cast(o_totalprice + 1 as decimal(12,2)) as amount, "
        f"{status} as status, {ts} as update_ts, {group} as order_group from orders where {where}"
        for key, status, ts, group, where in BATCH) + ")")


def upsert_sql(keys: tuple[str, ...], policy: str) -> str:
    names = ", ".join(keys)
    on = " and ".join(f"i.{k} = b.{k}" for k in keys)
    first = (f"incoming as (select * from batch qualify row_number() over (partition by {names} "
             "order by update_ts desc nulls last, customer_id, amount, status, order_group) = 1)")
    older = "b.update_ts is not null and (i.update_ts is null or i.update_ts < b.update_ts)"
    applied = f"applied as (select i.* from incoming i where not exists (select 1 from base b where {on} and {older}))"
    if policy == "incoming_wins":
        applied = "applied as (select * from incoming)"
    return (f"with {UPSERT_CTES}, {first}, {applied} "
            f"select b.* from base b where not exists (select 1 from applied i where {on}) "
            "union all select * from applied")


def _upsert(name: str, keys: tuple[str, ...], policy: str) -> None:
    QUERIES[name] = lambda spark, sf: merging.upsert(
        base_rows(spark, sf), batch_rows(spark, sf), keys, "update_ts", policy)
    ORACLE[name] = upsert_sql(keys, policy)


def _keyed_table(name: str, scope: str, policy: str) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        target = KeyedTable(scratch_path(spark, name), ("order_id",), "update_ts", "order_group", scope, policy)
        target.insert(base_rows(spark, sf))
        target.upsert(batch_rows(spark, sf))
        return target.snapshot(spark).orderBy("order_id")

    QUERIES[name] = run
    ORACLE[name] = upsert_sql(("order_id",) if scope == "table" else ("order_id", "order_group"), policy)


_upsert("upsert_incoming_wins", ("order_id",), "incoming_wins")
_upsert("upsert_latest_wins", ("order_id",), "latest_wins")
_upsert("upsert_within_partition", ("order_id", "order_group"), "latest_wins")
_keyed_table("keyed_table_incoming_wins", "table", "incoming_wins")
_keyed_table("keyed_table_latest_wins", "table", "latest_wins")
_keyed_table("keyed_table_within_partition", "partition", "incoming_wins")


def keyed_table_odd_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Missing, blank and oddly named partitions are partitions of their own, each found again by an upsert."""
    odd = ("case o_orderpriority when '1-URGENT' then null when '2-HIGH' then '' when '3-MEDIUM' then 'a/b =c%' else o_orderpriority end")
    orders = table(spark, sf, "orders").selectExpr("o_orderkey as order_id", "o_orderdate as update_ts", f"{odd} as order_group", "0 as changed")
    target = KeyedTable(scratch_path(spark, "odd-partitions"), ("order_id",), "update_ts", "order_group")
    target.insert(orders)
    target.upsert(orders.where("order_id % 3 = 0").withColumn("changed", F.lit(1)))
    return target.snapshot(spark)


QUERIES["keyed_table_odd_partitions"] = keyed_table_odd_partitions
ORACLE["keyed_table_odd_partitions"] = """
    select o_orderkey as order_id, o_orderdate as update_ts, cast(o_orderkey % 3 = 0 as int) as changed,
           case o_orderpriority when '1-URGENT' then null when '2-HIGH' then '' when '3-MEDIUM' then 'a/b =c%' else o_orderpriority end as order_group
    from orders"""


def keyed_table_new_column(spark: SparkSession, sf: str) -> DataFrame:
    """A batch brings a column, a later one lacks two: rows have NULLs where their batch had no such column."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey as order_id", "o_orderdate as update_ts", "o_orderpriority as order_group", "o_orderstatus as status")
    target = KeyedTable(scratch_path(spark, "new-column"), ("order_id",), "update_ts", "order_group", "table", evolve=True)
    target.insert(orders)
    target.upsert(orders.where("status = 'P'").withColumn("checked_by", F.concat(F.lit("clerk "), "order_id")))
    target.upsert(orders.where("order_id % 7 = 1").drop("status"))
    return target.snapshot(spark)


QUERIES["keyed_table_new_column"] = keyed_table_new_column
ORACLE["keyed_table_new_column"] = """
    select o_orderkey as order_id, o_orderdate as update_ts, o_orderpriority as order_group,
           if(o_orderkey % 7 = 1, null, o_orderstatus) as status,
           if(o_orderkey % 7 <> 1 and o_orderstatus = 'P', 'clerk ' || o_orderkey, null) as checked_by from orders"""


def keyed_table_months(spark: SparkSession, sf: str) -> DataFrame:
    """One partition a month, changed twice, superseded data removed, and the later half read by partition."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey as order_id", "o_orderdate as update_ts", "date(date_trunc('month', o_orderdate)) as order_month",
        "cast(o_totalprice as decimal(12,2)) as amount")
    target = KeyedTable(scratch_path(spark, "months"), ("order_id",), "update_ts", "order_month")
    target.insert(orders)
    for step in (1, 2):
        target.upsert(orders.where(f"order_id % 500 = {step}").withColumn("amount", F.expr(f"cast(amount + {step} as decimal(12,2))")))
    target.vacuum(spark)
    return target.snapshot(spark, where=F.col("order_month") >= F.lit("1995-06-01").cast("date"))


QUERIES["keyed_table_months"] = keyed_table_months
ORACLE["keyed_table_months"] = """
    select o_orderkey as order_id, o_orderdate as update_ts, cast(date_trunc('month', o_orderdate) as date) as order_month,
           cast(o_totalprice + case o_orderkey % 500 when 1 then 1 when 2 then 2 else 0 end as decimal(12,2)) as amount
    from orders where o_orderdate >= date '1995-06-01'"""


def precombined_batch(spark: SparkSession, sf: str) -> DataFrame:
    return merging.precombine(batch_rows(spark, sf), ["order_id"], "update_ts")


QUERIES["precombined_batch"] = precombined_batch
ORACLE["precombined_batch"] = (
    f"with {UPSERT_CTES} select * from batch qualify row_number() over (partition by order_id "
    "order by update_ts desc nulls last, customer_id, amount, status, order_group) = 1")


# --- sources and sinks --------------------------------------------------------------

def roundtrip_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """Folders written by a sink, found again by name and typed by a declared schema."""
    base = scratch_path(spark, "parquet")
    tables = {"orders_parquet": table(spark, sf, "orders"), "customer_parquet": table(spark, sf, "customer")}
    writers.write_tables(tables, {"base_path": base, "partition_by": {"orders_parquet": ["o_orderstatus"]}})
    found = readers.read_parquet_tables(
        spark, base, table_schemas={"orders": "o_orderkey bigint, o_custkey int, o_totalprice decimal(12,2)"},
        required=["orders", "customer"])
    names = found["customer"].select(F.col("c_custkey").cast("int").alias("o_custkey"), "c_name", "c_mktsegment", "c_acctbal")
    return found["orders"].join(names, "o_custkey", "left")


QUERIES["roundtrip_parquet"] = roundtrip_parquet
ORACLE["roundtrip_parquet"] = """
    select o_orderkey, cast(o_custkey as int) as o_custkey, o_orderstatus,
           cast(o_totalprice as decimal(12,2)) as o_totalprice, o_orderdate, o_orderpriority,
           c_name, c_mktsegment, c_acctbal from orders left join customer on c_custkey = o_custkey"""


def tsv_to_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """A tab-separated export with a header and empty fields, converted and read back."""
    base = scratch_path(spark, "tsv")
    exported = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cast(l_quantity as decimal(12,2)) as l_quantity",
        "cast(l_extendedprice as decimal(12,2)) as l_extendedprice",
        "cast(l_discount as decimal(4,2)) as l_discount", "cast(l_tax as decimal(4,2)) as l_tax",
        "nullif(l_returnflag, 'N') as l_returnflag", "int(l_linestatus = 'F') as is_final",
        "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') as l_shipdate")
    exported.write.csv(f"{base}/export", sep="\t", header=True, nullValue="")
    writers.tsv_to_parquet(spark, {"lines": f"{base}/export"}, f"{base}/out", {
        "lines": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity decimal(12,2), "
                 "l_extendedprice decimal(12,2), l_discount decimal(4,2), l_tax decimal(4,2), l_returnflag string, "
                 "is_final boolean, l_shipdate timestamp_ntz"})
    return readers.read_parquet_tables(spark, f"{base}/out")["lines"]


QUERIES["tsv_to_parquet"] = tsv_to_parquet
ORACLE["tsv_to_parquet"] = """
    select l_orderkey, cast(l_partkey as bigint) as l_partkey, cast(l_suppkey as bigint) as l_suppkey, l_linenumber,
           cast(l_quantity as decimal(12,2)) as l_quantity, cast(l_extendedprice as decimal(12,2)) as l_extendedprice,
           cast(l_discount as decimal(4,2)) as l_discount, cast(l_tax as decimal(4,2)) as l_tax, nullif(l_returnflag, 'N') as l_returnflag, l_linestatus = 'F' as is_final, l_shipdate from lineitem"""


def json_variant_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON feed whose attributes differ by row, read as variants."""
    path = scratch_path(spark, "json")
    feed = table(spark, sf, "events").selectExpr(
        "event_id", "event_type",
        "case when event_type = 'view' then to_json(named_struct('seen', user_id, 'parts', array(event_type, 'x'))) "
        "else props end as attributes")
    feed.selectExpr("event_id", "event_type", "parse_json(attributes) as attributes").write.json(path)
    read = readers.read_json(spark, path, "event_id bigint, event_type string, attributes variant", multi_line=False)
    return read.select(
        "event_id", "event_type", F.try_variant_get("attributes", "$.k", "int").alias("k"),
        F.try_variant_get("attributes", "$.seen", "bigint").alias("seen"),
        F.try_variant_get("attributes", "$.parts[0]", "string").alias("first_part"))


QUERIES["json_variant_scan"] = json_variant_scan
ORACLE["json_variant_scan"] = """
    select event_id, event_type, case when event_type <> 'view' then cast(json_extract_string(props, '$.k') as int) end as k,
           case when event_type = 'view' then user_id end as seen, case when event_type = 'view' then event_type end as first_part
    from events"""


def json_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """Feeds by name: those the settings leave out are not read."""
    base = scratch_path(spark, "feeds")
    reviews = cleaned(spark, sf, "product_reviews").select(
        "review_id", "product_id", "rating", "helpful_votes", "review_title", "review_text", "metadata",
        F.date_format("review_date", "yyyy-MM-dd HH:mm:ss").alias("review_date"))
    reviews.write.json(f"{base}/product_reviews")
    return flat_metadata(readers.read_json_feeds(
        spark, base, {"product_reviews": "product_reviews"},
        {"product_reviews": "review_id string, product_id string, rating int, helpful_votes int, review_title string, "
                            "review_text string, metadata struct<lang: string, source: string>, review_date string",
         "product_attributes": "product_id string"}, multi_line=False)["product_reviews"])


QUERIES["json_feeds"] = json_feeds
ORACLE["json_feeds"] = layer(
    "clean_product_reviews", "review_id, product_id, rating, helpful_votes, review_title, review_text, "
    "metadata.lang as metadata_lang, metadata.source as metadata_source, "
    "strftime(review_date, '%Y-%m-%d %H:%M:%S') as review_date")


def json_feed_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """A feed with every thirteenth record cut off: good rows, and the rest as they came."""
    path = scratch_path(spark, "json")
    table(spark, sf, "events").selectExpr(
        """concat('{"event_id":', event_id, ',"event_type":"', event_type, if(event_id % 13 = 0, '', '"}')) as value""").write.text(path)
    schema = "event_id bigint, event_type string"
    good = readers.read_json(spark, path, schema, multi_line=False, malformed="reject")
    return good.withColumn("record", F.lit(None).cast("string")).unionByName(
        readers.json_rejects(spark, path, schema, multi_line=False), allowMissingColumns=True)


QUERIES["json_feed_rejects"] = json_feed_rejects
ORACLE["json_feed_rejects"] = """
    select if(event_id % 13 = 0, null, event_id) as event_id, if(event_id % 13 = 0, null, event_type) as event_type,
           if(event_id % 13 = 0, concat('{"event_id":', event_id, ',"event_type":"', event_type), null) as record
    from events"""


def tsv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """An export in which some rows lack a field, have one too many, or hold a word for a number."""
    path = scratch_path(spark, "tsv")
    line = (r"concat_ws('\t', o_orderkey, if(o_orderkey % 7 = 1, 'word', string(o_custkey)), if(o_orderkey % 5 = 1, null, o_orderstatus), "
            r"if(o_orderkey % 11 = 1, 'more', null))")
    header = "o_orderkey\to_custkey\to_orderstatus"
    # lines are written as one column whose name is the whole header, so every file has it
    table(spark, sf, "orders").select(F.expr(line).alias(header)).write.option("header", True).option("sep", "\x01").csv(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"
    good = readers.read_tsv(spark, path, schema, malformed="reject")
    return good.withColumn("record", F.lit(None).cast("string")).unionByName(readers.tsv_rejects(spark, path, schema), allowMissingColumns=True)


QUERIES["tsv_rejects"] = tsv_rejects
ORACLE["tsv_rejects"] = r"""
    with lines as (select *, concat_ws(chr(9), o_orderkey, if(o_orderkey % 7 = 1, 'word', cast(o_custkey as varchar)),
                                      if(o_orderkey % 5 = 1, null, o_orderstatus), if(o_orderkey % 11 = 1, 'more', null)) as line,
                          o_orderkey % 7 = 1 or (o_orderkey % 5 = 1) <> (o_orderkey % 11 = 1) as bad from orders)
    select if(bad, null, o_orderkey) as o_orderkey, if(bad, null, o_custkey) as o_custkey,
           if(bad, null, if(o_orderkey % 5 = 1, 'more', o_orderstatus)) as o_orderstatus, if(bad, line, null) as record from lines"""


def catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """An external table of the session's catalog at a path of its own."""
    prefix = f"run_{uuid.uuid4().hex}_"
    sink = {"base_path": scratch_path(spark, "catalog"), "catalog_db": "default", "table_prefix": prefix}
    tables = {"reviews": flat_metadata(cleaned(spark, sf, "product_reviews"))}
    writers.write_tables(tables, sink)
    return writers.read_back(spark, tables, sink)["reviews"]


QUERIES["catalog_table"] = catalog_table
ORACLE["catalog_table"] = layer("clean_product_reviews", FLAT_METADATA_SQL)


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return writers.summary({name: table(spark, sf, name) for name in GIVEN}).drop("table_schema")


QUERIES["row_counts"] = row_counts
ORACLE["row_counts"] = " union all ".join(
    f"select '{name}' as table_name, count(*) as row_count from {name}" for name in GIVEN)


def rows_written(spark: SparkSession, sf: str) -> DataFrame:
    """The counts that the writes themselves report, for every table they wrote."""
    tables = {name: table(spark, sf, name) for name in GIVEN}
    counts = writers.write_tables(tables, {"base_path": scratch_path(spark, "counted")})
    reported = F.create_map(*[F.lit(x) for pair in sorted(counts.items()) for x in pair])
    return row_counts(spark, sf).select("table_name", reported[F.col("table_name")].cast("bigint").alias("row_count"))


QUERIES["rows_written"] = rows_written
ORACLE["rows_written"] = ORACLE["row_counts"]


def one_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources under one set of names, the later one winning where names repeat."""
    tables = readers.catalog({"orders": table(spark, sf, "customer"), "nation": table(spark, sf, "nation"),
                              "customer": table(spark, sf, "customer")},
                             {"orders": table(spark, sf, "orders")})
    keys = [df.select(F.lit(name).alias("table_name"), F.col(df.columns[0]).cast("bigint").alias("key"))
            for name, df in tables.items()]
    return reduce(DataFrame.unionByName, keys)


QUERIES["one_catalog"] = one_catalog
ORACLE["one_catalog"] = """
    select 'orders' as table_name, cast(o_orderkey as bigint) as key from orders
    union all select 'nation', n_nationkey from nation union all select 'customer', c_custkey from customer"""


def literal_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A small table of literals with days and times, looked up by every order."""
    states = readers.from_rows(
        spark, [("F", "final", "1992-01-01", "1992-01-01 08:30:00"), ("O", "open", "no day", None)],
        ["state", "state_name", "valid_from", "loaded_at"], timestamps=["loaded_at"], days=["valid_from"])
    loaded = states.withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("state"))
    return lookup_left(orders, loaded, "state", ["state_name", "valid_from", "loaded_at"])


QUERIES["literal_rows"] = literal_rows
ORACLE["literal_rows"] = """
    select o_orderkey, o_orderstatus as state, case o_orderstatus when 'F' then 'final' when 'O' then 'open' end as state_name,
           case when o_orderstatus = 'F' then date '1992-01-01' end as valid_from,
           case when o_orderstatus = 'F' then timestamp '1992-01-01 08:30:00' end as loaded_at from orders"""


def whole_run(spark: SparkSession, sf: str) -> DataFrame:
    """Exports and feeds written, all layers built from them by one published run; every table it
    wrote with its rows as counted by the run, and rows and a digest of all values as found again."""
    base = scratch_path(spark, "run")
    exported = [name for name in SHAPES if name not in FEEDS]
    writers.write_tables({f"{name}_parquet": raw(spark, sf, name) for name in exported}, {"base_path": f"{base}/raw"})
    for name in FEEDS:
        raw(spark, sf, name).write.json(f"{base}/feeds/{name}")
    settings = {
        "relational": {"base_path": f"{base}/raw", "required": exported},
        "feeds": {"base_path": f"{base}/feeds", "files": {name: name for name in FEEDS}, "multi_line": False},
        "silver": {"base_path": f"{base}/silver", "publish": True, "partition_by": {"fact_payments": ["payment_method_code"]}},
        "gold": {"base_path": f"{base}/gold", "publish": True},
    }
    counted = layers.run(spark, settings, AS_OF_DATE, run_time())
    found = reduce(DataFrame.unionByName, [
        digest(name, df) for layer_name in ("silver", "gold") for name, df in writers.stored(
            spark, [n for n in counted if n.startswith("gold_") == (layer_name == "gold")], settings[layer_name]).items()])
    reported = F.create_map(*[F.lit(x) for pair in sorted(counted.items()) for x in pair])
    return found.withColumn("rows_written", reported[F.col("table_name")].cast("bigint"))


def digest(name: str, df: DataFrame) -> DataFrame:
    """A table's rows and the sum of 52 bits of each row's MD5, which does not follow the order of rows.

    A row's text holds its columns by name, without missing ones; fractions count to six places.
    """
    if "metadata" in df.columns:  # a variant, as feeds are read
        parts = {f"metadata_{part}": F.variant_get("metadata", f"$.{part}", "string") for part in ("lang", "source")}
        df = df.withColumns(parts).drop("metadata")
    fractions = {c for c, kind in df.dtypes if kind == "double"}
    texts = [F.concat(F.lit(f"{c}="), (F.round(c, 6).cast("decimal(20,6)") if c in fractions else F.col(c)).cast("string"))
             for c in sorted(df.columns)]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 13), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(bits).cast("string").alias("digest")).withColumn("table_name", F.lit(name))


FRACTIONS = {"fact_order_items": "effective_discount_pct", "gold_daily_sales_customer": "avg_order_value",
             "gold_product_review_summary": "avg_rating", "gold_payment_summary": "avg_payment_amount"}


# flags that exports hold as 0/1 and that are booleans once read by their declared schemas
READ_AS_FLAGS = ("dim_product", "dim_product_variant", "dim_promotion")


def digest_sql(name: str) -> str:
    columns = FLAT_METADATA_SQL if name == "fact_product_reviews" else "*"
    if name in FRACTIONS:
        columns = f"* replace (cast(round({FRACTIONS[name]}, 6) as decimal(20,6)) as {FRACTIONS[name]})"
    if name in READ_AS_FLAGS:
        columns = "* replace (cast(is_active as boolean) as is_active)"
    return f"""
        select '{name}' as table_name, count(*) as row_count, count(*) as rows_written,
               cast(sum(cast('0x' || substr(md5(line), 1, 13) as bigint)) as varchar) as digest
        from (select string_agg(name || '=' || value, '|' order by name) as line from (
                  unpivot (select _row, cast(columns(* exclude (_row)) as varchar)
                           from (select row_number() over () as _row, {columns} from {name}))
                  on * exclude (_row) into name name value value) group by _row)"""


QUERIES["whole_run"] = whole_run
ORACLE["whole_run"] = with_ctes(" union all ".join(digest_sql(name) for name in (*SOURCES, *MART_SOURCES)))
