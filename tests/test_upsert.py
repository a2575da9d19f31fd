"""Upserts as plans and on versioned tables, against a brute-force table in Python."""

import random
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from retail_layers.operators import upsert as merging
from retail_layers.sinks import versioned
from retail_layers.sinks.versioned import KeyedTable
from retail_layers.sources import paths
from retail_layers.sources.readers import from_rows

COLUMNS = ["order_id", "customer_id", "amount", "status", "update_ts", "order_date"]
BASE = [
    ("a7", "mia", 31.5, "OPEN", "2024-06-03 10:00:00", "2024-06-03"),
    ("b2", "tom", 12.0, "OPEN", "2024-06-03 07:45:00", "2024-06-03"),
    ("c9", "lea", 88.25, "SENT", "2024-06-03 21:10:00", "2024-06-03"),
]
BATCH = [
    ("a7", "mia", 29.0, "CHANGED", "2024-06-03 22:30:00", "2024-06-03"),
    ("d4", "ivo", 45.0, "OPEN", "2024-06-03 22:31:00", "2024-06-03"),
]
AFTER = [("a7", 29.0, "CHANGED"), ("b2", 12.0, "OPEN"), ("c9", 88.25, "SENT"), ("d4", 45.0, "OPEN")]


def typed(spark, data):
    if not data:
        return typed(spark, BASE).limit(0)
    return from_rows(spark, data, COLUMNS, ["update_ts"], ["order_date"])


def short(df):
    return [tuple(r) for r in df.orderBy("order_id").select("order_id", "amount", "status").collect()]


def table(path, **settings):
    return KeyedTable(path, ("order_id",), "update_ts", "order_date", **settings)


def test_literal_rows_are_typed(spark):
    df = typed(spark, BASE)
    assert [t for _, t in df.dtypes] == ["string", "string", "double", "string", "timestamp", "date"]
    assert df.first()["update_ts"] == datetime(2024, 6, 3, 10)


@pytest.mark.parametrize("policy", merging.POLICIES)
def test_batch_updates_and_inserts(spark, policy):
    out = merging.upsert(typed(spark, BASE), typed(spark, BATCH), ["order_id"], "update_ts", policy)
    assert short(out) == AFTER


def test_unknown_policy_and_scope(spark, folder):
    with pytest.raises(ValueError, match="policy"):
        merging.upsert(typed(spark, BASE), typed(spark, BATCH), ["order_id"], "update_ts", "newest")
    with pytest.raises(ValueError, match="scope"):
        table(folder, scope="galaxy")


def test_precombine_prefers_later_then_present_times(spark):
    batch = [("a7", "c", 1.0, "a", "2024-06-03 10:00:00", "2024-06-03"), ("a7", "c", 2.0, "b", "2024-06-03 12:00:00", "2024-06-03"),
             ("a7", "c", 3.0, "c", None, "2024-06-03"), ("b2", "c", 4.0, "d", None, "2024-06-03")]
    assert short(merging.precombine(typed(spark, batch), ["order_id"], "update_ts")) == [("a7", 2.0, "b"), ("b2", 4.0, "d")]


@pytest.mark.parametrize(("when", "incoming", "latest"), [
    ("2024-06-03 09:00:00", 9.0, 31.5),  # older
    ("2024-06-03 10:00:00", 9.0, 9.0),    # same time: the batch wins
    (None, 9.0, 31.5),                   # no time
])
def test_policies_on_old_rows(spark, when, incoming, latest):
    batch = typed(spark, [("a7", "c1", 9.0, "X", when, "2024-06-03")] if when else
                  [("a7", "c1", 9.0, "X", None, "2024-06-03"), ("e5", "c1", 9.0, "X", "2024-06-03 10:00:00", "2024-06-03")])
    for policy, amount in (("incoming_wins", incoming), ("latest_wins", latest)):
        out = merging.upsert(typed(spark, BASE), batch, ["order_id"], "update_ts", policy)
        assert dict((k, a) for k, a, _ in short(out))["a7"] == amount


def test_a_small_batch_does_not_shuffle_the_base(spark, folder):
    spark.range(1000).selectExpr("id as k", "id as v", "timestamp_ntz'2025-01-01 00:00:00' as ts").write.parquet(folder)
    base = spark.read.parquet(folder)
    batch = spark.createDataFrame([(5, 50, datetime(2025, 2, 1))], "k bigint, v bigint, ts timestamp_ntz")
    out = merging.upsert(base, batch, ["k"], "ts")
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_table_insert_upsert_and_history(spark, folder):
    t = table(folder)
    assert t.version(spark) == 0
    with pytest.raises(ValueError, match="no committed version"):
        t.snapshot(spark)
    assert t.insert(typed(spark, BASE)) == 1
    assert t.upsert(typed(spark, BATCH)) == 2
    assert short(t.snapshot(spark)) == AFTER
    assert t.snapshot(spark).dtypes == typed(spark, BASE).dtypes
    assert len(short(t.snapshot(spark, 1))) == 3
    assert t.upsert(typed(spark, BATCH)) == 3 and short(t.snapshot(spark)) == AFTER  # replayed
    assert t.upsert(typed(spark, [])) == 3  # nothing to do
    t.insert(typed(spark, BATCH))
    assert [k for k, *_ in short(t.snapshot(spark))] == ["a7", "d4"]


def test_first_upsert_starts_the_table(spark, folder):
    t = table(folder)
    assert t.upsert(typed(spark, BATCH)) == 1
    assert len(short(t.snapshot(spark))) == 2


def test_a_table_does_not_start_empty(spark, folder):
    with pytest.raises(ValueError, match="no rows"):
        table(folder).insert(typed(spark, []))
    assert table(folder).version(spark) == 0


def test_untouched_partitions_are_not_rewritten(spark, folder):
    t = table(folder)
    t.insert(typed(spark, BASE + [("e5", "c9", 1.0, "NEW", "2024-06-04 10:00:00", "2024-06-04")]))
    t.upsert(typed(spark, BATCH))
    assert list(paths.folders(spark, f"{folder}/data/version=2", "_part=*")) == ["_part=v2024-06-03"]
    assert len(short(t.snapshot(spark))) == 5


def test_a_commit_without_its_listing_does_not_count(spark, folder):
    t = table(folder)
    t.insert(typed(spark, BASE))
    typed(spark, BATCH).selectExpr("*", "'v2024-06-03' as _part").write.partitionBy("_part").parquet(f"{folder}/data/version=2")
    assert t.version(spark) == 1 and len(short(t.snapshot(spark))) == 3
    t.upsert(typed(spark, BATCH))
    assert short(t.snapshot(spark)) == AFTER


def test_moved_keys_by_scope(spark, tmp_path):
    moved = [("a7", "c1", 7.0, "MOVED", "2024-06-04 08:00:00", "2024-06-04")]
    by_table, by_partition = table(str(tmp_path / "t"), scope="table"), table(str(tmp_path / "p"))
    for t in (by_table, by_partition):
        t.insert(typed(spark, BASE[:1]))
        t.upsert(typed(spark, moved))
    assert short(by_table.snapshot(spark)) == [("a7", 7.0, "MOVED")]  # its old partition is gone
    assert sorted(a for _, a, _ in short(by_partition.snapshot(spark))) == [7.0, 31.5]


def test_missing_partition_values_and_odd_text(spark, folder):
    data = [("a7", None, 1), ("b2", "a/b =c", 1), ("c9", "007", 1)]
    t = KeyedTable(folder, ("id",), "n", "grp", scope="table")
    t.insert(spark.createDataFrame(data, "id string, grp string, n int"))
    t.upsert(spark.createDataFrame([("a7", None, 2), ("c9", "a/b =c", 2)], "id string, grp string, n int"))
    got = sorted(tuple(r) for r in t.snapshot(spark).select("id", "n").collect())
    assert got == [("a7", 2), ("b2", 1), ("c9", 2)]
    assert {r["id"]: r["grp"] for r in t.snapshot(spark).collect()} == {"a7": None, "b2": "a/b =c", "c9": "a/b =c"}


@pytest.mark.parametrize("scope", ["table", "partition"])
def test_blank_and_missing_partitions_are_two_that_both_match(spark, folder, scope):
    t = KeyedTable(folder, ("id",), "n", "grp", scope)
    schema = "id string, n int, grp string, v int"
    t.insert(spark.createDataFrame([("a", 1, "", 10), ("b", 1, None, 20), ("c", 1, "n", 30), ("d", 1, "v", 40)], schema))
    t.upsert(spark.createDataFrame([("a", 2, "", 11), ("b", 2, None, 21), ("c", 2, "n", 31)], schema))
    got = sorted((tuple(r) for r in t.snapshot(spark).collect()), key=str)
    assert got == [("a", 2, "", 11), ("b", 2, None, 21), ("c", 2, "n", 31), ("d", 1, "v", 40)]


def test_missing_keys_are_refused(spark, folder):
    good = spark.createDataFrame([("a", 1, "x")], "id string, n int, grp string")
    bad = spark.createDataFrame([(None, 1, "x")], good.schema)
    with pytest.raises(Exception, match="key column id"):
        merging.upsert(good, bad, ["id"], "n").collect()
    t = KeyedTable(folder, ("id",), "n", "grp")
    with pytest.raises(Exception, match="key column id"):
        t.insert(bad)
    t.insert(good)
    with pytest.raises(Exception, match="key column id"):
        t.upsert(bad)
    assert t.version(spark) == 1


@pytest.mark.parametrize("scope", ["table", "partition"])
def test_columns_come_only_when_asked_for_and_never_go(spark, tmp_path, scope):
    old = spark.createDataFrame([("a", 1, "x", 5), ("b", 1, "y", 6)], "id string, n int, grp string, v int")
    wider = spark.createDataFrame([("a", 2, "x", 7, "new")], "id string, n int, grp string, v int, extra string")
    narrower = spark.createDataFrame([("c", 2, "z")], "id string, n int, grp string")
    strict = KeyedTable(str(tmp_path / "strict"), ("id",), "n", "grp", scope)
    strict.insert(old)
    for batch, name in ((wider, "extra"), (narrower, "v")):
        with pytest.raises(ValueError, match=name):
            strict.upsert(batch)
        with pytest.raises(ValueError, match=name):
            merging.upsert(old, batch, ["id"], "n")
    with pytest.raises(ValueError, match="v"):
        strict.upsert(old.withColumn("v", old["v"].cast("string")))
    open_ = KeyedTable(str(tmp_path / "open"), ("id",), "n", "grp", scope, evolve=True)
    open_.insert(old)
    open_.upsert(wider)
    open_.upsert(narrower)
    got = sorted(tuple(r) for r in open_.snapshot(spark).select("id", "n", "grp", "v", "extra").collect())
    assert got == [("a", 2, "x", 7, "new"), ("b", 1, "y", 6, None), ("c", 2, "z", None, None)]
    assert open_.snapshot(spark, 1).columns == old.columns


def test_policy_is_checked_at_once(folder):
    with pytest.raises(ValueError, match="policy"):
        table(folder, policy="newest")


@pytest.mark.parametrize("scope", ["table", "partition"])
@pytest.mark.parametrize("policy", merging.POLICIES)
def test_many_batches_against_brute_force(spark, folder, scope, policy):
    random.seed(f"{scope}{policy}")
    t = KeyedTable(folder, ("k",), "ts", "d", scope, policy)
    held = {}
    for step in range(4):
        batch = [(random.randint(0, 12), random.choice([None, *range(6)]), date(2025, 1, random.randint(1, 3)), step * 100 + i)
                 for i in range(10)]
        first = {}
        for k, ts, d, v in batch:
            key = (k, d) if scope == "partition" else k
            rank = (ts is None, -(ts or 0), d if scope == "table" else date.min, v)
            if key not in first or rank < first[key][0]:
                first[key] = (rank, (k, ts, d, v))
        for key, (_, row) in first.items():
            old = held.get(key)
            if policy == "incoming_wins" or old is None or old[1] is None or (row[1] is not None and row[1] >= old[1]):
                held[key] = row
        df = spark.createDataFrame(batch, "k int, ts int, d date, v int")
        t.insert(df) if step == 0 else t.upsert(df)
        assert sorted(map(tuple, t.snapshot(spark).collect()), key=str) == sorted(held.values(), key=str)


def rows_scanned(df):
    """Rows that left each Parquet scan of a frame, run without adaptive execution."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(i).metrics() for i in range(leaves.length())]
    return [m.apply("numOutputRows").value() for m in metrics if m.contains("numOutputRows")]


def spoil(path):
    for file in Path(path).rglob("part-*"):
        file.write_bytes(b"no parquet")


def test_a_condition_on_the_partition_opens_no_other_folder(spark, folder):
    t = table(folder)
    days = [("x%d" % d, "c", 1.0, "NEW", "2024-06-01 10:00:00", "2024-06-%02d" % d) for d in range(1, 9)]
    t.insert(typed(spark, days))
    t.upsert(typed(spark, [("y", "c", 2.0, "NEW", "2024-06-03 10:00:00", "2024-06-03")]))
    for d in (1, 2, 4, 5, 6, 7, 8):
        spoil(f"{folder}/data/version=1/_part=v2024-06-{d:02d}")
    spoil(f"{folder}/data/version=1/_part=v2024-06-03")  # replaced by the second version
    where = F.col("order_date") == F.lit("2024-06-03").cast("date")
    assert [k for k, *_ in short(t.snapshot(spark, where=where))] == ["x3", "y"]
    assert short(t.snapshot(spark, where=F.col("order_date") > F.lit("2025-01-01").cast("date"))) == []
    plan = t.snapshot(spark, where=where)._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan and "v2024-06-03" not in plan.split("== Optimized")[0]
    with pytest.raises(Exception):
        t.snapshot(spark).collect()


@pytest.mark.parametrize(("kind", "values"), [
    ("string", ["a", "", None, "x/y=z"]), ("int", [1, -2, None]), ("double", [0.5, float("nan"), None]),
    ("timestamp_ntz", [datetime(2025, 1, 1, 2, 3, 4, 5), None]), ("timestamp", [datetime(2025, 1, 1, 2), None]),
    ("decimal(9,3)", [Decimal("1.250"), None]), ("boolean", [True, False, None])])
def test_conditions_on_partitions_of_any_type(spark, folder, kind, values):
    rows = [(i, 1, v) for i, v in enumerate(values)]
    t = KeyedTable(folder, ("id",), "n", "grp")
    t.insert(spark.createDataFrame(rows, f"id int, n int, grp {kind}"))
    for i, n, v in rows:
        where = F.col("grp").eqNullSafe(F.lit(v).cast(kind))
        assert [r["id"] for r in t.snapshot(spark, where=where).collect()] == [i]


def test_looking_up_a_few_keys_reads_a_small_part_of_the_table(spark, folder, conf):
    rows = spark.range(40_000).selectExpr("xxhash64(id) as k", "md5(string(id)) as s", "1 as n", "id % 40 as grp", "id as v")
    t = KeyedTable(folder, ("k", "s"), "n", "grp", "table")
    t.insert(rows)
    moved = rows.where("v in (7, 8, 47)").withColumn("grp", F.lit(3).cast("bigint")).withColumn("n", F.lit(2))
    absent = rows.where("v < 2").withColumn("k", F.col("k") + 1)
    batch = moved.union(absent.withColumn("grp", F.lit(3).cast("bigint")))
    conf(spark__sql__adaptive__enabled="false")
    held = t.snapshot(spark).where(t.may_hold(batch))
    assert held.where("v in (7, 8, 47)").count() == 3
    assert max(rows_scanned(t.snapshot(spark).where(t.may_hold(batch)))) <= 4_000  # of 40,000: groups 7 and 8, chance aside
    # a batch of many keys goes by their range
    tail = rows.where("k > 9000000000000000000").withColumn("n", F.lit(2))
    conf(spark__sql__adaptive__enabled="true")
    t.upsert(batch)
    t.upsert(tail)
    got = t.snapshot(spark)
    assert got.count() == 40_002 and got.where("v in (7, 8, 47) and n = 2 and grp = 3").count() == 3
    assert got.where("n = 2").count() == tail.where("v not in (7, 8, 47)").count() + 3


@pytest.mark.parametrize("few", [0, 5])
def test_batches_by_value_and_by_range_agree(spark, folder, monkeypatch, few):
    monkeypatch.setattr(versioned, "FEW_KEYS", few)
    t = KeyedTable(folder, ("k", "d"), "n", "grp", "table")
    schema = "k string, d date, n int, grp int"
    days = [date(2025, 1, d) for d in (1, 2, 3)]
    t.insert(spark.createDataFrame([(k, d, 1, i) for i, k in enumerate("abcd") for d in days], schema))
    t.upsert(spark.createDataFrame([("a", days[0], 2, 3), ("c", days[2], 2, 0), ("zz", days[1], 2, 9)], schema))
    got = {(r["k"], r["d"]): (r["n"], r["grp"]) for r in t.snapshot(spark).collect()}
    want = {(k, d): (1, i) for i, k in enumerate("abcd") for d in days}
    want |= {("a", days[0]): (2, 3), ("c", days[2]): (2, 0), ("zz", days[1]): (2, 9)}
    assert got == want


def test_vacuum_keeps_what_the_last_versions_name(spark, folder):
    t = table(folder)
    t.insert(typed(spark, BASE + [("e5", "c9", 1.0, "NEW", "2024-06-04 10:00:00", "2024-06-04"), ("f6", "c9", 1.0, "x", None, None)]))
    t.upsert(typed(spark, BATCH))
    typed(spark, BATCH).write.parquet(f"{folder}/data/version=3/_part=vcut-off")  # a commit that failed
    before = short(t.snapshot(spark))
    assert t.vacuum(spark, versions=2) == 1  # the failed one's
    assert len(short(t.snapshot(spark, 1))) == 5 and short(t.snapshot(spark)) == before
    assert t.vacuum(spark) == 1
    assert list(paths.folders(spark, f"{folder}/data/version=1", "_part=*")) == ["_part=n", "_part=v2024-06-04"]
    assert short(t.snapshot(spark)) == before and t.version(spark) == 2 and t.vacuum(spark) == 0
    with pytest.raises(ValueError, match="no committed version 1"):
        t.snapshot(spark, 1)
    t.insert(typed(spark, BATCH))
    assert t.vacuum(spark) == 2 and [k for k, *_ in short(t.snapshot(spark))] == ["a7", "d4"]
    assert list(paths.folders(spark, f"{folder}/data")) == ["version=3"]
    with pytest.raises(ValueError, match="stay"):
        t.vacuum(spark, 0)
    assert table(f"{folder}-none").vacuum(spark) == 0


def test_vacuum_finds_folders_of_odd_names(spark, folder):
    t = KeyedTable(folder, ("id",), "n", "grp")
    first = [("a", 1, "x/y =z%"), ("b", 1, "ü[1]"), ("c", 1, None), ("d", 1, "stays")]
    t.insert(spark.createDataFrame(first, "id string, n int, grp string"))
    t.upsert(spark.createDataFrame([(k, 2, g) for k, _, g in first[:3]], "id string, n int, grp string"))
    assert t.vacuum(spark) == 3
    assert sorted(map(tuple, t.snapshot(spark).collect())) == sorted(
        [(k, 2, g) for k, _, g in first[:3]] + [first[3]], key=lambda r: r[0])


def test_many_partitions_need_no_literal_each(spark, folder):
    t = KeyedTable(folder, ("k",), "n", "grp")
    t.insert(spark.range(300).selectExpr("id as k", "1 as n", "id as grp"))
    t.upsert(spark.range(10).selectExpr("id as k", "2 as n", "id as grp"))
    got = t.snapshot(spark)
    assert got.agg(F.count("*"), F.sum("n")).first()[:] == (300, 310)
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 5_000
