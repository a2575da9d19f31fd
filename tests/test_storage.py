"""Sources, sinks, settings and scratch space."""

import json
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import samples
from retail_layers import scratch
from retail_layers.plans import schemas
from retail_layers.sinks import writers
from retail_layers.sources import paths, readers, settings


def test_tsv_types_flags_and_empty_fields(spark, folder):
    files = samples.write(folder)
    customer = readers.read_tsv(spark, files["customer"], schemas.RELATIONAL["customer"])
    assert customer.where("customer_id = 23").select("date_of_birth", "gender").first() == (None, "NULL")
    address = readers.read_tsv(spark, files["customer_address"], schemas.RELATIONAL["customer_address"])
    assert [r["is_default"] for r in address.orderBy("customer_address_id").collect()] == [True, False, True, True]
    assert address.first()["postal_code"] == "022765"
    item = readers.read_tsv(spark, files["order_item"], schemas.RELATIONAL["order_item"]).orderBy("order_item_id").first()
    assert (item["base_unit_price"], item["created_at"]) == (Decimal("500.00"), datetime(2024, 3, 4, 8, 16))


def test_tsv_header_has_to_match(spark, tmp_path):
    bad = tmp_path / "customer_status"
    bad.write_text("status_code description\nACTIVE  Active customer\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_tsv(spark, str(bad), schemas.RELATIONAL["customer_status"]).collect()


def test_tsv_without_a_schema_is_inferred(spark, folder):
    files = samples.write(folder)
    assert dict(readers.read_tsv(spark, files["order_item"]).dtypes)["base_unit_price"] == "double"


def test_tsv_to_parquet_and_discovery(spark, folder):
    files = samples.write(folder)
    rows = writers.tsv_to_parquet(spark, files, f"{folder}/out", schemas.RELATIONAL)
    assert rows["inventory_level"] == 10 and rows["orders"] == 3
    assert set(readers.discover_parquet(spark, f"{folder}/out")) == set(files)
    tables = readers.read_parquet_tables(spark, f"{folder}/out", names={"order_status": "status"}, required=["orders", "status"])
    assert "status" in tables and "order_status" not in tables
    with pytest.raises(ValueError, match="shipment"):
        readers.read_parquet_tables(spark, f"{folder}/out", required=["shipment"])


def test_missing_and_empty_source_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.discover_parquet(spark, str(tmp_path / "nowhere"))
    with pytest.warns(UserWarning, match="_parquet"):
        assert readers.discover_parquet(spark, str(tmp_path)) == {}


def test_declared_types_win_over_stored_ones(spark, folder):
    spark.createDataFrame([(1, 400001, 15.5, 1)], "order_id bigint, postal_code int, amount double, is_active int") \
        .write.parquet(f"{folder}/t_parquet")
    df = readers.read_parquet_tables(spark, folder, table_schemas={
        "t": "order_id int, postal_code string, amount decimal(12,2), is_active boolean"})["t"]
    assert tuple(df.first()) == (1, "400001", Decimal("15.50"), True)


def test_json_feeds_read_only_what_is_named(spark, folder):
    samples.write(folder)
    feeds = readers.read_json_feeds(spark, f"{folder}/feeds", {"product_attributes": "product_attributes.json"})
    assert set(feeds) == {"product_attributes"}
    got = feeds["product_attributes"].orderBy("product_id").select(
        F.try_variant_get("attributes", "$.weight_g", "int").alias("weight"),
        F.try_variant_get("attributes", "$.flavours[1]", "string").alias("flavour"),
        F.try_variant_get("attributes", "$.sizes.S.cm", "int").alias("cm"),
        F.try_variant_get("attributes", "$.raw_milk", "boolean").alias("raw")).collect()
    assert [tuple(r) for r in got] == [(1000, "malt", None, None), (7000, None, None, True), (None, None, 95, None)]


def test_json_lines_and_inference(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(r) for r in samples.REVIEWS))
    assert readers.read_json(spark, str(path), multi_line=False).count() == 3
    whole = tmp_path / "array.json"
    whole.write_text(json.dumps(samples.REVIEWS))
    inferred = readers.read_json(spark, str(whole))
    assert set(inferred.schema["metadata"].dataType.names) == {"shop_ip", "device", "browser"}


def test_malformed_json_fails_or_is_set_apart(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"a": 1, "b": "x"}\n{"a": 2, "b"\nnothing\n{"a": 3, "b": null}\n')
    read = lambda **how: readers.read_json(spark, str(path), "a int, b string", multi_line=False, **how)
    with pytest.raises(Exception, match="(?i)malformed"):
        read().collect()
    assert sorted(tuple(r) for r in read(malformed="reject").collect()) == [(1, "x"), (3, None)]
    assert read(malformed="reject").count() == 2
    rejects = readers.json_rejects(spark, str(path), "a int, b string", multi_line=False)
    assert sorted(r["record"] for r in rejects.collect()) == ["nothing", '{"a": 2, "b"']
    with pytest.raises(ValueError, match="clicks"):
        readers.read_json_feeds(spark, str(tmp_path), {"clicks": "lines.json"})
    with pytest.raises(ValueError, match="fail or reject"):
        read(malformed="ignore")


def test_two_folders_of_one_table_are_an_error(spark, folder):
    for name in ("orders", "order"):
        spark.range(1).write.parquet(f"{folder}/{name}_parquet")
    with pytest.raises(ValueError, match="orders"):
        readers.read_parquet_tables(spark, folder, names={"order": "orders"})


def test_catalog_later_source_wins(spark):
    a, b = spark.range(1), spark.range(2)
    assert readers.catalog({"x": a, "y": a}, {"x": b}) == {"x": b, "y": a}


def test_environment_sections():
    both = {"environments": {"dev": {"silver": 1}}}
    assert settings.for_environment(both, "dev") == {"silver": 1}
    with pytest.raises(ValueError, match="environments"):
        settings.for_environment({}, "dev")
    with pytest.raises(ValueError, match="prod"):
        settings.for_environment(both, "prod")
    with pytest.raises(ValueError, match="gold"):
        settings.required({"silver": 1}, "gold", "dev")


def test_sink_kinds():
    assert writers.sink_kind({"base_path": "/x"}) == "folder"
    assert writers.sink_kind({"base_path": "s3://x", "catalog_db": "db"}) == "catalog"
    assert writers.sink_kind({"jdbc": {}}) == "jdbc"
    with pytest.raises(ValueError, match="silver"):
        writers.sink_kind(None, "silver")
    with pytest.raises(ValueError, match="base_path"):
        writers.sink_kind({"format": "parquet"})


def test_jdbc_options_take_the_password_from_the_environment(monkeypatch):
    jdbc = {"url": "jdbc:x://h/db", "user": "u", "schema": "gold", "table_prefix": "g_", "batchsize": 5000}
    monkeypatch.delenv(writers.PASSWORD_VARIABLE, raising=False)
    with pytest.raises(ValueError, match=writers.PASSWORD_VARIABLE):
        writers.jdbc_options(jdbc, "sales")
    monkeypatch.setenv(writers.PASSWORD_VARIABLE, "secret")
    assert writers.jdbc_options(jdbc, "sales") == {
        "url": "jdbc:x://h/db", "dbtable": "gold.g_sales", "user": "u", "password": "secret", "batchsize": "5000"}
    assert writers.jdbc_options({"url": "u", "user": "x"}, "t")["dbtable"] == "public.t"
    more = writers.jdbc_options({"url": "u", "user": "x", "options": {"truncate": True, "user": "y"}}, "t")
    assert more["truncate"] == "True" and more["user"] == "x"


def test_stored_tables_are_found_by_name(spark, folder, rows):
    for sink in ({"base_path": f"{folder}/a"}, {"base_path": f"{folder}/b", "catalog_db": "default", "table_prefix": "st_"}):
        writers.write_tables({"t": spark.range(3)}, sink)
        assert rows(writers.stored(spark, ["t"], sink)["t"]) == [(0,), (1,), (2,)]


def test_writes_report_rows_and_read_back(spark, folder):
    tables = {"a": spark.range(5), "b": spark.range(7).selectExpr("id", "id % 2 as half")}
    sink = {"base_path": folder, "partition_by": {"b": ["half"]}}
    assert writers.write_tables(tables, sink) == {"a": 5, "b": 7}
    assert sorted(p.name for p in Path(folder, "b").glob("half=*")) == ["half=0", "half=1"]
    assert {n: df.count() for n, df in writers.read_back(spark, tables, sink).items()} == {"a": 5, "b": 7}
    assert writers.write_tables({"a": spark.range(2)}, sink | {"mode": "append"}) == {"a": 2}
    assert writers.read_back(spark, tables, sink)["a"].count() == 7
    assert writers.write_tables({}, sink) == {}
    with pytest.raises(ValueError, match="JDBC"):
        writers.read_back(spark, tables, {"jdbc": {}})


def test_catalog_sink_makes_external_tables(spark, folder):
    sink = {"base_path": folder, "catalog_db": "default", "table_prefix": "shop_", "format": "parquet"}
    assert writers.write_tables({"t": spark.range(3)}, sink) == {"t": 3}
    assert spark.table("default.shop_t").count() == 3
    assert Path(folder, "t").is_dir()
    assert writers.read_back(spark, {"t": spark.range(3)}, sink)["t"].count() == 3
    spark.sql("drop table default.shop_t")


def test_empty_tables_and_folder_columns_read_back(spark, folder):
    some = spark.createDataFrame([("007", 1)], "code string, n int")
    tables = {"none": some.where("n < 0"), "some": some, "joined": some.where("n < 0").join(spark.range(3).toDF("n"), "n")}
    sink = {"base_path": folder, "partition_by": {"none": ["code"], "some": ["code"]}}
    assert writers.write_tables(tables, sink) == {"none": 0, "some": 1, "joined": 0}
    back = writers.read_back(spark, tables, sink)
    assert {n: df.dtypes for n, df in back.items()} == {n: df.dtypes for n, df in tables.items()}
    assert tuple(back["some"].first()) == ("007", 1) and back["none"].count() == 0


def test_summary(spark, rows):
    out = writers.summary({"a": spark.range(3), "b": spark.range(0)})
    assert rows(out) == [("a", "struct<id:bigint>", 3), ("b", "struct<id:bigint>", 0)]
    known = writers.summary({"a": spark.range(3), "b": spark.range(0)}, {"a": 7})
    assert rows(known) == [("a", "struct<id:bigint>", 7), ("b", "struct<id:bigint>", 0)] and known.schema == out.schema


def test_folders_lists_sorted_matches(spark, tmp_path):
    for name in ("b_x", "a_x", "c"):
        (tmp_path / name).mkdir()
    (tmp_path / "file_x").write_text("")
    assert list(paths.folders(spark, str(tmp_path), "*_x")) == ["a_x", "b_x"]
    assert paths.folders(spark, str(tmp_path / "nowhere")) == {}


def test_scratch_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_path(spark, "x").startswith(f"{root}/x-")
    scratch.keep(spark.range(3)).count()
    assert Path(root).is_dir()


def test_scratch_is_required_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session())


def test_malformed_tsv_rows_are_set_apart(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("a\tflag\tc\n1\t1\tx\n2\t0\n3\t1\tx\tmore\nword\t0\ty\n\t\t\n6\t\t\n5\t0\t\n")  # a row of nothing but tabs is none
    schema = "a int, flag boolean, c string"
    read = lambda **how: readers.read_tsv(spark, str(path), schema, **how)
    assert read().count() == 6
    good = read(malformed="reject")
    assert sorted((tuple(r) for r in good.collect()), key=str) == [(1, True, "x"), (5, False, None), (6, None, None)]
    assert good.count() == 3 and good.select("c").count() == 3
    rejects = readers.tsv_rejects(spark, str(path), schema)
    assert sorted(r["record"] for r in rejects.collect()) == ["2\t0", "3\t1\tx\tmore", "word\t0\ty"]
    for call in (lambda: readers.read_tsv(spark, str(path), malformed="reject"), lambda: read(malformed="drop"),
                 lambda: readers.read_json(spark, str(path), malformed="reject")):
        with pytest.raises(ValueError):
            call()
