"""Integrity checks."""

import pytest

from retail_layers.operators import quality
from retail_layers.plans import integrity


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert rows(quality.duplicate_keys(df, ["a", "b"])) == [(None, 1, 2), (1, 1, 2)]


def test_orphans_ignore_missing_references(spark, rows):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "ref int")
    parent = spark.createDataFrame([(2,), (2,)], "id int")
    assert rows(quality.orphans(child, ["ref"], parent, ["id"])) == [(1, 2)]


def test_composite_and_self_references(spark, rows):
    child = spark.createDataFrame([(1, "x"), (1, "y"), (None, "y")], "a int, b string")
    parent = spark.createDataFrame([(1, "x")], "p int, q string")
    assert rows(quality.orphans(child, ["a", "b"], parent, ["p", "q"])) == [(1, "y", 1)]
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "id int, parent int")
    assert rows(quality.orphans(tree, ["parent"], tree, ["id"])) == [(9, 1)]


def test_children_are_counted_before_the_join(spark):
    child = spark.range(10).selectExpr("id % 2 as ref")
    shown = quality.orphans(child, ["ref"], spark.range(1), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert shown.index("Join LeftOuter") < shown.index("Aggregate")


def test_null_counts(spark, rows):
    df = spark.createDataFrame([(None, "x"), (None, None), (1, "y")], "`a b` int, c string")
    assert rows(quality.null_counts(df, ["a b", "c"])) == [("a b", 2), ("c", 1)]
    assert rows(quality.null_counts(df.limit(0), ["c"])) == [("c", 0)]


def test_report_over_declared_constraints(spark, rows):
    tables = {
        "brand": spark.createDataFrame([(1, "a"), (1, None)], "brand_id int, brand_name string"),
        "category": spark.createDataFrame([(1, None, 1), (2, 9, 2)], "category_id int, parent_category_id int, category_level int"),
        "unrelated": spark.range(1),
    }
    assert rows(integrity.report(tables)) == sorted([
        ("unique", "brand", "brand_id", 1), ("unique", "category", "category_id", 0),
        ("reference", "category", "parent_category_id", 1),
        ("not null", "brand", "brand_id", 0), ("not null", "brand", "brand_name", 1),
        ("not null", "category", "category_id", 0), ("not null", "category", "category_level", 0)],
        key=lambda r: [(v is not None, str(v)) for v in r])
    with pytest.raises(ValueError, match="none"):
        integrity.report({"unrelated": spark.range(1)})


def test_report_reads_each_table_twice_and_agrees_with_single_checks(spark, rows, folder):
    spark.range(4000).selectExpr(
        "int(id % 3900) as order_id", "if(id % 3 = 0, 7, int(id % 50)) as customer_id", "timestamp_seconds(id) as order_date",
        "if(id % 9 = 0, null, int(id)) as billing_address_id").write.parquet(f"{folder}/orders")
    spark.range(40).selectExpr("int(id) as customer_id", "concat('m', id % 38) as email", "if(id = 3, null, 'A') as first_name").write.parquet(f"{folder}/customer")
    spark.range(3000).selectExpr("int(id) as customer_address_id", "int(id % 60) as customer_id").write.parquet(f"{folder}/customer_address")
    spark.range(900).selectExpr("if(id % 2 = 0, null, int(id % 30)) as warehouse_id", "int(id % 45) as product_variant_id").write.parquet(f"{folder}/inventory_level")
    tables = {n: spark.read.parquet(f"{folder}/{n}") for n in ("orders", "customer", "customer_address", "inventory_level")}
    report = integrity.report(tables)
    shown = report._jdf.queryExecution().executedPlan().toString()
    assert shown.count("FileScan parquet") == 2 * len(tables) and shown.count("Exchange hashpartitioning(number") == 2
    got = {(r["check"], r["table_name"], r["column_names"]): r["violations"] for r in report.collect()}
    want = {("unique", n, c): df.count() for (n, c), df in integrity.repeated_keys(tables).items()}
    want |= {("reference", n, c): sum(r["row_count"] for r in df.collect()) for (n, c), df in integrity.broken_references(tables).items()}
    want |= {("not null", n, r["column_name"]): r["null_rows"] for n, df in integrity.missing_values(tables).items() for r in df.collect()}
    assert got == want and min(sum(v for (k, *_), v in want.items() if k == kind) for kind in ("unique", "reference", "not null")) > 0
