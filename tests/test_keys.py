"""Deduplication, top-1, sequences, lookups: results, skew paths and plan shapes."""

import hashlib
import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retail_layers.operators import keys, skew, slices
from retail_layers.operators.joins import lookup_left
from retail_layers.plans import enrich, star


def plan(df):
    return df._jdf.queryExecution().toString()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_require_keys_reaches_the_scan(spark, folder):
    spark.range(10).withColumn("b", F.col("id")).write.parquet(folder)
    shown = plan(keys.require_keys(spark.read.parquet(folder), ["id", "b"]))
    assert "IsNotNull(id)" in shown and "IsNotNull(b)" in shown


def test_dedup_keeps_the_least_row_and_treats_null_keys_as_one(spark, rows):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 9), (1, "a", 8), (None, "y", 1), (None, "x", 1)], "k int, p string, q int")
    assert rows(keys.dedup(df, ["k"])) == [(None, "x", 1), (1, "a", 8)]
    assert rows(keys.dedup(df, ["k"], [F.col("q").desc(), "p"])) == [(None, "x", 1), (1, "a", 9)]
    assert rows(keys.dedup(df.select("k"), ["k"])) == [(None,), (1,)]


def test_dedup_keeps_the_last_update_and_the_fullest_of_equals(spark, rows):
    df = spark.createDataFrame(
        [(1, None, 2020), (1, "Ann", 2025), (2, None, 7), (2, "Bo", 7), (3, "Cy", None), (3, "Di", 1)],
        "k int, name string, updated_at int")
    assert rows(keys.dedup(df, ["k"])) == [(1, "Ann", 2025), (2, "Bo", 7), (3, "Di", 1)]
    assert rows(keys.dedup_rare(df, ["k"])) == rows(keys.dedup(df, ["k"]))


def test_long_columns_decide_last_and_by_digest(spark, rows):
    texts = ["b" * 9000, "a" * 9000, "c"]
    data = [(1, t, {"k": i}, 5) for i, t in enumerate(texts)] + [(2, "z", None, 1), (2, "y", {"k": 1}, 2), (3, None, None, 1), (3, "x", None, 1)]
    df = spark.createDataFrame(data, "k int, text string, meta map<string,int>, q int")
    for frame in (df, df.repartition(3)):
        out = {r["k"]: r for r in keys.dedup(frame, ["k"], long=["text", "meta"]).collect()}
        assert out[1]["text"] == min(texts, key=lambda t: hashlib.md5(t.encode()).hexdigest())
        assert out[2]["text"] == "z" and out[3]["text"] == "x"
    assert keys.dedup_rare(df, ["k"], long=["text", "meta"]).count() == 3


def test_top_one_is_cut_before_the_exchange(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    shown = plan(keys.first_per_group(df, ["k"], ["v"]))
    partial = shown.rindex("Partial")
    assert "WindowGroupLimit" in shown and partial > shown.rindex("Exchange hashpartitioning")


def test_dedup_rare_equals_dedup_and_shuffles_no_single_rows(spark, rows):
    random.seed(5)
    data = [(random.randint(0, 400), random.randint(0, 3), str(i)) for i in range(600)] + [(None, 0, "n"), (None, 0, "m")]
    df = spark.createDataFrame(data, "a int, b int, p string")
    want = rows(keys.dedup(df, ["a", "b"]))
    assert rows(keys.dedup_rare(df, ["a", "b"])) == want
    unique = spark.range(50).selectExpr("id as k", "id as v")
    assert keys.dedup_rare(unique, ["k"]) is unique


@pytest.mark.parametrize("hot", [2, 20, 10_000])
def test_keys_that_are_not_rare_are_dealt_once_by_the_next_joins_column(spark, rows, monkeypatch, hot):
    """``near`` of one key may differ or be missing; ``hot`` rows of a key, or of ``near``, are too many for a task."""
    monkeypatch.setattr(keys, "MAX_GROUP_ROWS", hot)
    monkeypatch.setattr(keys, "TASK_ROWS", 100)
    random.seed(8)
    data = [(k, k // 3 if k % 5 else random.choice([None, 1, 2]), random.randint(0, 3), str(i))
            for i, k in enumerate(random.randint(0, 300) for _ in range(900))]
    df = spark.createDataFrame([*data, (None, 1, 0, "n"), (None, None, 0, "m")], "k int, o int, v int, p string")
    same = df.where("k % 5 <> 0 and k % 3 = 0")
    for given in (df, same):
        want = rows(keys.dedup(given, ["k"]))
        assert rows(keys.dedup_rare(given, ["k"], near="o")) == want and rows(keys.dedup_rare(given, ["k"])) == want
    dealt = keys.dedup_rare(same, ["k"], near="o")._jdf.queryExecution().executedPlan().toString()
    assert dealt.count("Exchange") == 1 and ("hashpartitioning(o#" in dealt) == (hot > 2)


def brute_sequence(data):
    groups = {}
    for k, o, tie in data:
        groups.setdefault(k, []).append(((o is not None, o), tie))
    return {(k, tie): i for k, members in groups.items() for i, (_, tie) in enumerate(sorted(members), 1)}


@pytest.mark.parametrize("limit", [10**6, 1500, 0])
def test_sequence_with_one_key_holding_a_third(spark, limit):
    random.seed(limit)
    start = datetime(2025, 1, 1)
    data = []
    for i in range(12000):
        key = 7 if i % 3 == 0 else (None if i % 11 == 0 else random.randint(0, 60))
        # many ties, and all of one key's rows at one moment
        when = start if key == 7 and i % 2 else (None if random.random() < 0.1 else start + timedelta(days=random.randint(0, 9)))
        data.append((key, when, i))
    df = spark.createDataFrame(data, "customer_id int, order_date timestamp, order_id int").repartition(5)
    out = enrich.number_orders(df, max_group_rows=limit)
    got = {(r["customer_id"], r["order_id"]): r["customer_order_sequence"] for r in out.collect()}
    assert got == brute_sequence(data)
    assert out.where("is_first_order <> (customer_order_sequence = 1)").count() == 0
    assert out.schema["customer_order_sequence"].dataType.simpleString() == "bigint"


def cut(df, by, numbers, rows):
    large = skew.keys_above(df, by, rows)
    cuts, starts = slices.cut_groups(df, by, numbers, large, rows)
    return slices.mark(df, by, numbers, cuts), cuts, starts


def test_large_groups_are_spread_over_slices(spark):
    df = spark.range(20000).selectExpr("int(id % 2) as k", "id as v").unionAll(spark.range(30).selectExpr("int(5) as k", "id as v"))
    marked, _, _ = cut(df, ["k"], [F.col("v")], 1000)
    sizes = {(r["k"], tuple(r["_slice"])): r["count"] for r in marked.groupBy("k", "_slice").count().collect()}
    assert sizes.pop((5, ())) == 30
    assert len(sizes) == 20 and max(sizes.values()) <= 2000 and min(sizes.values()) >= 500
    out = keys.sequence(df, ["k"], [F.col("v").asc_nulls_first()], "n", max_group_rows=1000, slice_on=[F.col("v")])
    assert out.where("k < 5").agg(F.count_if(F.col("n") != F.floor(F.col("v") / 2) + 1)).first()[0] == 0


def test_a_heavy_value_is_cut_on_the_next_number(spark):
    """Nine tenths at one moment, the last of all, and rows that agree in everything."""
    df = spark.range(30000).selectExpr("1 as k", "if(id % 10 = 0, id, 50000L) as v", "if(id > 20000, 1L, id) as w")
    marked, cuts, _ = cut(df, ["k"], [F.col("v"), F.col("w")], 1000)
    assert len(cuts) == 2
    sizes = marked.groupBy("_slice").agg(F.count("*").alias("n"), F.countDistinct("v", "w").alias("d")).collect()
    assert all(r["n"] <= 2000 or r["d"] == 1 for r in sizes) and len(sizes) > 15


def test_more_slices_than_one_cut_gives(spark):
    marked, cuts, _ = cut(spark.range(40000).selectExpr("1 as k", "id as v"), ["k"], [F.col("v")], 100)
    sizes = [r["count"] for r in marked.groupBy("_slice").count().collect()]
    assert len(cuts) == 2 and max(sizes) <= 200 and len(sizes) > 200


def test_wide_rows_are_read_once_whether_groups_are_cut_or_not(spark, folder):
    spark.range(30000).selectExpr("if(id % 3 = 0, 7, id) as k", "id as v", "cast(id as string) as pad").write.parquet(folder)
    df = spark.read.parquet(folder)
    for limit in (1000, 10**6):
        shown = plan(keys.sequence(df, ["k"], [F.col("v").asc_nulls_first()], "n", max_group_rows=limit, slice_on=[F.col("v")]))
        shown = shown[shown.index("== Physical Plan =="):]
        assert "rangepartitioning" not in shown
        assert shown.count("pad:string") == 1 and shown.count("Exchange hashpartitioning") == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=40),
       st.integers(0, 5))
def test_sequence_property(spark, pairs, limit):
    data = [(k, o, i) for i, (k, o) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k int, o int, tie int")
    out = keys.sequence(df, ["k"], [F.col("o").asc_nulls_first(), F.col("tie").asc()], "n", max_group_rows=limit,
                        slice_on=[slices.order_number(df, c) for c in ("o", "tie")], least_rows=1)
    assert {(r["k"], r["tie"]): r["n"] for r in out.collect()} == brute_sequence(data)


def test_numbers_follow_moments_dates_and_whole_numbers(spark):
    df = spark.sql("""select timestamp_seconds(id * 40000) as a, cast(timestamp_seconds(id * 40000) as timestamp_ntz) as b,
                      date_add(date'1969-12-01', int(id)) as c, cast(id as smallint) as d, string(id) as e from range(60)""")
    assert slices.order_number(df, "e") is None
    for c in "abcd":
        found = [r[0] for r in df.orderBy(c).select(slices.order_number(df, c)).collect()]
        assert found == sorted(found) and len(set(found)) == 60


def test_sizes_from_another_frame_only_steer(spark):
    data = [(1, i % 4, i) for i in range(30)]
    df = spark.createDataFrame(data, "k int, o int, tie int")
    order = [F.col("o").asc(), F.col("tie").asc()]
    raw = df.unionAll(df)
    out = keys.sequence(df, ["k"], order, "n", max_group_rows=40, sizes=raw, slice_on=[F.col("o"), F.col("tie")], least_rows=1)
    assert {(r["k"], r["tie"]): r["n"] for r in out.collect()} == brute_sequence(data)


def test_keys_above_counts_before_the_exchange(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c")], "k int, s string")
    assert rows(skew.keys_above(df, ["k", "s"], 1)) == [(None, "b", 2), (1, "a", 2)]
    assert skew.keys_above(df, ["k"], 2) is None


def test_ties_without_a_key_are_settled_by_the_other_columns(spark):
    data = [(1, 5, "b"), (1, 5, "a"), (1, None, "c")]
    df = spark.createDataFrame(data, "customer_id int, order_date int, status string")
    for limit in (10, 0):
        out = enrich.number_orders(df, max_group_rows=limit)
        assert {r["status"]: r["customer_order_sequence"] for r in out.collect()} == {"c": 1, "a": 2, "b": 3}


def lookup_frames(spark):
    facts = spark.createDataFrame([(i, 7 if i % 3 == 0 else (None if i % 10 == 1 else i)) for i in range(300)], "id int, k int")
    dim = spark.createDataFrame([(i, f"name{i}", "unused") for i in range(0, 300, 7)], "key int, name string, other string")
    return facts, dim


@pytest.mark.parametrize("limit", [None, 10**6, 20, 0])
def test_lookup_keeps_every_row(spark, rows, limit):
    facts, dim = lookup_frames(spark)
    known = {i: f"name{i}" for i in range(0, 300, 7)}
    out = lookup_left(facts, dim, "k", {"name": "label"}, dim_on="key", max_key_rows=limit)
    assert sorted(out.columns) == ["id", "k", "label"]
    assert {(r["id"], r["k"], r["label"]) for r in out.collect()} == {(r["id"], r["k"], known.get(r["k"])) for r in facts.collect()}
    assert out.count() == 300


def test_lookup_prunes_the_dimension(spark, folder):
    spark.range(9).selectExpr("id as key", "id as name", "id as other").write.parquet(folder)
    shown = plan(lookup_left(spark.range(5).toDF("k"), spark.read.parquet(folder), "k", {"name": "n"}, dim_on="key"))
    schema = shown[shown.rindex("ReadSchema:"):]
    assert "name" in schema and "other" not in schema


def skewed_items(spark):
    items = spark.range(60000).selectExpr(
        "id as order_item_id", "if(id % 3 = 0, 7, id) as order_id", "id % 50 as product_variant_id", "int(1) as quantity",
        "cast(2 as decimal(18,2)) as gross_amount", "cast(id as string) as pad")
    orders = spark.range(60000).selectExpr("id as order_id", "id as customer_key", "int(20250101) as order_date_key")
    return items, orders


def test_written_facts_split_a_hot_order(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
         spark__sql__adaptive__coalescePartitions__enabled="false")
    items, orders = skewed_items(spark)
    assert "skew=true" in final_plan(star.fact_order_items(items, orders))


def test_lines_are_read_once_and_hot_orders_join_without_their_key(spark, conf, folder):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__coalescePartitions__enabled="false")
    items, orders = skewed_items(spark)
    items.where("order_id <> 14").unionAll(items.selectExpr("order_item_id", "cast(null as bigint) as order_id", *items.columns[2:]).limit(900)) \
        .repartition(6).write.parquet(folder)
    items = spark.read.parquet(folder)
    out = star.fact_order_items(items, orders, max_key_rows=1000)
    shown = final_plan(out)
    shown = shown[:shown.index("== Initial Plan ==")]
    assert "BroadcastHashJoin" in shown and "SortMergeJoin" in shown and shown.count("pad") == 0
    assert shown.count("FileScan parquet") == 2  # lines, and the written few rows of the hot orders
    got = out.groupBy("order_id").agg(F.count("*").alias("n"), F.min("customer_key").alias("c"), F.max("order_date_key").alias("d"))
    per_order = {r["order_id"]: (r["n"], r["c"], r["d"]) for r in got.where("n > 1").collect()}
    assert per_order == {7: (20001, 7, 20250101), None: (900, None, None)}
    sizes = out.withColumn("_p", F.spark_partition_id()).groupBy("_p").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < out.count() / 4 and sizes[1] == 8


def test_hot_key_without_a_match_and_too_many_hot_keys(spark, rows, monkeypatch):
    facts, dim = lookup_frames(spark)
    dim = dim.where("key <> 7")
    want = rows(lookup_left(facts, dim, "k", {"name": "label"}, dim_on="key"))
    assert rows(lookup_left(facts, dim, "k", {"name": "label"}, dim_on="key", max_key_rows=5)) == want
    monkeypatch.setattr("retail_layers.operators.joins.is_small", lambda df: False)
    assert rows(lookup_left(facts, dim, "k", {"name": "label"}, dim_on="key", max_key_rows=5)) == want
