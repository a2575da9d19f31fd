"""Time the library's plans next to the usual way of writing the same thing.

Same tables, session and protocol as ``bench.py``; prints one JSON line per pair.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bench import RUNS, seconds, session
from retail_layers.operators import keys, upsert
from retail_layers.plans import marts
from retail_queries import layer_queries, storage_queries
from retail_queries.shapes import table

LINE_KEYS = ["l_orderkey", "l_linenumber"]


def silver(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The star tables that the sales mart reads, as written silver."""
    base = tempfile.mkdtemp(prefix="bench-silver-")
    built = layer_queries.star_tables(spark, sf, layer_queries.MART_SOURCES["gold_daily_sales_product"])
    for name in ("fact_order_items", "dim_product_variant"):
        built[name].write.mode("overwrite").parquet(f"{base}/{name}")
    return {name: spark.read.parquet(f"{base}/{name}") for name in ("fact_order_items", "dim_product_variant")}


def union_and_rank(spark: SparkSession, sf: str) -> DataFrame:
    both = storage_queries.base_rows(spark, sf).withColumn("_new", F.lit(0)).unionByName(
        storage_queries.batch_rows(spark, sf).withColumn("_new", F.lit(1)))
    newest = Window.partitionBy("order_id").orderBy(F.desc("_new"), F.desc_nulls_last("update_ts"), "amount", "status")
    return both.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", "_new")


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    star = silver(spark, sf)
    items, variants = star["fact_order_items"], star["dim_product_variant"]
    wide = variants.select("product_variant_key", *marts.PRODUCT_ATTRIBUTES)
    pairs = {
        "one row per key": (
            lambda s, d: keys.dedup(table(s, d, "lineitem"), LINE_KEYS),
            lambda s, d: table(s, d, "lineitem").dropDuplicates(LINE_KEYS)),
        "one row per key, none repeated": (
            lambda s, d: keys.dedup_rare(table(s, d, "orders"), ["o_orderkey"]),
            lambda s, d: table(s, d, "orders").dropDuplicates(["o_orderkey"])),
        "sales mart from silver": (
            lambda s, d: marts.daily_sales_by_product(items, variants),
            lambda s, d: marts.daily_sales_by_product(items.join(wide, "product_variant_key", "left"))),
        "upsert": (
            lambda s, d: upsert.upsert(storage_queries.base_rows(s, d), storage_queries.batch_rows(s, d),
                                       ["order_id"], "update_ts"),
            union_and_rank),
    }
    for name, ways in pairs.items():
        times = []
        for way in ways:
            seconds(spark, way, sf)
            times.append(round(statistics.median(seconds(spark, way, sf) for _ in range(RUNS)), 3))
        print(json.dumps({"what": name, "library": times[0], "usual": times[1], "unit": "sec"}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
