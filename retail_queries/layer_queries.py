"""Queries over whole layers: each table cleaned, enriched, as star table and as mart."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_layers.operators.skew import MAX_GROUP_ROWS
from retail_layers.plans import clean, enrich, marts, star
from retail_queries.layer_sql import AS_OF, RUN_TS, layer, layer_in_zone
from retail_queries.shapes import raw

Query = Callable[[SparkSession, str], DataFrame]

AS_OF_DATE = date.fromisoformat(AS_OF)
ZONE, ZONE_HOURS = "Pacific/Honolulu", -10
SOURCES = {
    "dim_date": ("orders",),
    "dim_customer": ("customer", "customer_address"),
    "dim_product": ("product", "brand", "category"),
    "dim_product_variant": ("product_variant", "product", "brand", "category"),
    "dim_promotion": ("promotion",),
    "fact_orders": ("orders",),
    "fact_order_items": ("order_item", "orders"),
    "fact_payments": ("payment",),
    "fact_product_reviews": ("product_reviews",),
}
MART_SOURCES = {
    "gold_daily_sales_product": ("order_item", "orders", "product_variant", "product", "brand", "category"),
    "gold_daily_sales_customer": ("orders", "customer", "customer_address"),
    "gold_product_review_summary": ("product_reviews",),
    "gold_payment_summary": ("payment",),
}


def run_time() -> Column:
    return F.expr(f"timestamp_ntz'{RUN_TS}'")


def cleaned(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return clean.clean_table(name, raw(spark, sf, name), run_time())


def enriched(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source = raw(spark, sf, name)
    return enrich.enrich_table(name, clean.clean_table(name, source, run_time()), AS_OF_DATE, sizes=source)


def star_tables(spark: SparkSession, sf: str, sources: tuple[str, ...]) -> dict[str, DataFrame]:
    """Star tables by the way a whole run takes: only repeated keys are shuffled to be made unique."""
    given = {name: raw(spark, sf, name) for name in sources}
    cleaned_tables = clean.clean_tables(given, run_time(), rare_duplicates=True)
    return star.build_star(enrich.enrich_tables(cleaned_tables, AS_OF_DATE, given), raw=given)


def star_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return star_tables(spark, sf, SOURCES[name])[name]


def mart(spark: SparkSession, sf: str, name: str) -> DataFrame:
    built = star_tables(spark, sf, MART_SOURCES[name])
    lines = raw(spark, sf, "order_item").select(F.col("product_variant_id").alias("product_variant_key"))
    return marts.build_marts(built, unique_orders=True, max_key_rows=MAX_GROUP_ROWS, sizes=lines)[name]


def flat_metadata(df: DataFrame) -> DataFrame:
    """Nested values as plain columns, which hash alike in both engines."""
    return df.withColumns({"metadata_lang": F.col("metadata.lang"),
                           "metadata_source": F.col("metadata.source")}).drop("metadata")


def flat_attributes(df: DataFrame) -> DataFrame:
    return df.withColumn("attribute_k", F.variant_get("attributes", "$.k", "int")).drop("attributes")


FLAT_METADATA_SQL = "* exclude (metadata), metadata.lang as metadata_lang, metadata.source as metadata_source"
FLAT_ATTRIBUTES_SQL = ("* exclude (attributes), "
                       "cast(json_extract_string(attributes, '$.k') as int) as attribute_k")
NESTED = {
    "product_reviews": (flat_metadata, FLAT_METADATA_SQL),
    "fact_product_reviews": (flat_metadata, FLAT_METADATA_SQL),
    "product_attributes": (flat_attributes, FLAT_ATTRIBUTES_SQL),
}

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _add(name: str, build: Callable, table: str, sql_name: str | None = None) -> None:
    flatten, columns = NESTED.get(table, (None, "*"))

    def query(spark: SparkSession, sf: str) -> DataFrame:
        df = build(spark, sf, table)
        return flatten(df) if flatten else df

    QUERIES[name] = query
    ORACLE[name] = layer(sql_name or name, columns)


def cleaned_rare(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return clean.clean_table(name, raw(spark, sf, name), run_time(), rare_duplicates=True)


def items_hot_orders(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The same facts with every order above five lines set apart from the shuffled join."""
    tables = {t: enriched(spark, sf, t) for t in SOURCES[name]}
    return star.build_star(tables, max_key_rows=5, raw={"order_item": raw(spark, sf, "order_item")})[name]


def star_in_zone(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Stored moments of orders are instants here, text is read and days are cut as clocks in ``ZONE`` show them."""
    given = {}
    for source in SOURCES[name]:
        df = raw(spark, sf, source)
        given[source] = df.withColumn("order_date", F.col("order_date").cast("timestamp")) if source == "orders" else df
    cleaned_tables = clean.clean_tables(given, run_time(), rare_duplicates=True, zone=ZONE)
    return star.build_star(enrich.enrich_tables(cleaned_tables, AS_OF_DATE, given, zone=ZONE), raw=given, zone=ZONE)[name]


def mart_in_zone(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Text read in the session's zone (UTC), days cut in ``ZONE``."""
    return marts.build_marts(star_tables(spark, sf, MART_SOURCES[name]), unique_orders=True, zone=ZONE)[name]


_add("clean_orders_rare_duplicates", cleaned_rare, "orders", "clean_orders")
_add("clean_inventory_rare_duplicates", cleaned_rare, "inventory_level", "clean_inventory_level")
_add("clean_reviews_rare_duplicates", cleaned_rare, "product_reviews", "clean_product_reviews")
_add("fact_order_items_hot_orders", items_hot_orders, "fact_order_items", "fact_order_items")
for _table in [*clean.RULES, "customer_address", "brand", "category", "promotion"]:
    _add(f"clean_{_table}", cleaned, _table)
for _table in ("customer", "customer_address", "product", "product_variant", "inventory_level", "orders",
               "order_item", "payment", "product_reviews", "promotion"):
    _add(f"enrich_{_table}", enriched, _table)
for _table in SOURCES:
    _add(_table, star_table, _table)
for _table in MART_SOURCES:
    _add(_table, mart, _table)

for _table, _build in (("dim_date", star_in_zone), ("fact_orders", star_in_zone), ("fact_payments", star_in_zone),
                       ("gold_payment_summary", mart_in_zone), ("gold_product_review_summary", mart_in_zone)):
    QUERIES[f"{_table}_in_zone"] = lambda spark, sf, _table=_table, _build=_build: _build(spark, sf, _table)
    ORACLE[f"{_table}_in_zone"] = layer_in_zone(_table, ZONE_HOURS)
