"""The small shop from exports to marts, with results worked out by hand."""

import json
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import samples
from retail_layers import __main__ as cli
from retail_layers.plans import clean, enrich, layers, marts, schemas, star
from retail_layers.sinks import published, writers
from retail_layers.sources import readers

AS_OF, RUN = date(2025, 11, 30), datetime(2025, 11, 30)


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("shop") / "in")
    files = samples.write(base)
    writers.tsv_to_parquet(spark, files, f"{base}/raw", schemas.RELATIONAL)
    return {
        "relational": {"base_path": f"{base}/raw", "required": ["orders", "order_item"]},
        "feeds": {"base_path": f"{base}/feeds", "files": {
            "product_reviews": "product_reviews.json", "product_attributes": "product_attributes.json"}},
        "silver": {"base_path": f"{base}/silver", "partition_by": {"fact_orders": ["order_date_key"]}},
        "gold": {"base_path": f"{base}/gold"},
    }


@pytest.fixture(scope="module")
def written(spark, shop):
    return layers.run(spark, shop, AS_OF, RUN, null_tokens=["NULL"])


@pytest.fixture(scope="module")
def lazy(spark, shop):
    return layers.build_layers(layers.read_sources(spark, shop), AS_OF, RUN, ["NULL"])


def read(spark, shop, layer, name):
    return spark.read.parquet(f"{shop[layer]['base_path']}/{name}")


def test_rows_written(written):
    assert written == {
        "fact_orders": 3, "dim_customer": 3, "dim_product": 3, "dim_promotion": 2, "fact_payments": 4,
        "fact_product_reviews": 3, "dim_date": 3, "dim_product_variant": 5, "fact_order_items": 4,
        "gold_daily_sales_product": 4, "gold_daily_sales_customer": 3, "gold_product_review_summary": 3,
        "gold_payment_summary": 4}


def test_written_equals_lazy(spark, shop, written, lazy, rows):
    silver, gold = lazy
    for layer, tables in (("silver", silver), ("gold", gold)):
        for name, df in tables.items():
            plain = [c for c in df.columns if c != "metadata"]
            assert rows(read(spark, shop, layer, name), *plain) == rows(df, *plain), name


def test_star_columns(lazy):
    silver, _ = lazy
    for name, ddl in (("dim_date", star.DIM_DATE), ("dim_customer", star.DIM_CUSTOMER), ("dim_product", star.DIM_PRODUCT),
                      ("dim_product_variant", star.DIM_PRODUCT_VARIANT), ("dim_promotion", star.DIM_PROMOTION),
                      ("fact_orders", star.FACT_ORDERS), ("fact_order_items", star.FACT_ORDER_ITEMS),
                      ("fact_payments", star.FACT_PAYMENTS), ("fact_product_reviews", star.FACT_PRODUCT_REVIEWS)):
        declared = readers.parse_schema(ddl)
        assert [(f.name, f.dataType) for f in silver[name].schema] == [(f.name, f.dataType) for f in declared], name


def test_dim_date(spark, shop, written, rows):
    assert rows(read(spark, shop, "silver", "dim_date")) == [
        (20240304 + i, date(2024, 3, 4 + i), 2024, 1, 3, "March", 10, 4 + i, day) for i, day in enumerate(("Mon", "Tue", "Wed"))]


def test_dim_customer(spark, shop, written, rows):
    got = rows(read(spark, shop, "silver", "dim_customer"), "customer_key", "age_years", "age_band", "is_active_flag", "gender",
               "city_normalized", "is_metro_city", "postal_code", "email_is_valid", "phone_is_valid")
    assert got == [(21, 41, "36_45", True, "F", "CHENNAI", True, "022765", True, True),
                   (22, 21, "18_25", True, "M", "HAMBURG", False, "020095", True, True),
                   (23, None, "UNKNOWN", False, None, "DELHI", True, "011001", True, True)]


def test_fact_orders(spark, shop, written, rows):
    got = rows(read(spark, shop, "silver", "fact_orders"), "order_id", "amount_mismatch_flag", "order_value_band",
               "customer_order_sequence", "is_first_order", "order_status_is_valid", "order_date_key")
    assert got == [(61, False, "MEDIUM", 1, True, True, 20240304), (62, True, "HIGH", 1, True, True, 20240305),
                   (63, False, "LOW", 1, True, True, 20240306)]


def test_fact_order_items(spark, shop, written, rows):
    got = rows(read(spark, shop, "silver", "fact_order_items"), "order_item_id", "customer_key", "gross_amount", "net_line_amount")
    assert got == [(71, 21, D("2000.00"), D("2098.00")), (72, 21, D("480.00"), D("482.00")),
                   (73, 22, D("12000.00"), D("12640.00")), (74, 23, D("930.00"), D("1005.00"))]
    shares = [r[1] for r in rows(read(spark, shop, "silver", "fact_order_items"), "order_item_id", "effective_discount_pct")]
    assert shares == pytest.approx([2.5, 6.25, 5 / 3, 0])


def test_attempts_stock_and_promotions(spark, shop, written, rows):
    assert rows(read(spark, shop, "silver", "fact_payments"), "payment_id", "payment_attempt_number") == [(81, 1), (82, 1), (83, 2), (84, 1)]
    tables = layers.read_sources(spark, shop)
    stock = enrich.enrich_table("inventory_level", clean.clean_table("inventory_level", tables["inventory_level"], RUN), AS_OF)
    assert rows(stock.where("is_low_stock or is_out_of_stock"), "warehouse_id", "product_variant_id", "available_qty") == [(8, 53, 8), (9, 53, 0)]
    for day, active in ((date(2025, 11, 30), [5, 6]), (date(2025, 12, 1), [5])):
        out = enrich.enrich_table("promotion", tables["promotion"], day).where("is_currently_active")
        assert [r[0] for r in rows(out, "promotion_id")] == active


def test_daily_sales_by_product(spark, shop, written, rows):
    got = rows(read(spark, shop, "gold", "gold_daily_sales_product").drop("product_name", "brand_id", "default_category_id"))
    assert got == [
        (20240304, 51, 41, "Harbour Bakery", "Bread", 4, D("2000.00"), D("50.00"), D("140.00"), D("8.00"), D("2098.00"), 1),
        (20240304, 54, 43, "Oakroot", "Spades", 1, D("480.00"), D("30.00"), D("28.00"), D("4.00"), D("482.00"), 1),
        (20240305, 53, 42, "Mill Lane", "Cheese", 3, D("12000.00"), D("200.00"), D("840.00"), D("0.00"), D("12640.00"), 1),
        (20240306, 51, 41, "Harbour Bakery", "Bread", 2, D("930.00"), D("0.00"), D("65.10"), D("9.90"), D("1005.00"), 1)]


def test_daily_sales_by_customer(spark, shop, written, rows):
    got = rows(read(spark, shop, "gold", "gold_daily_sales_customer"), "order_date_key", "customer_key", "order_count",
               "total_revenue", "avg_order_value", "first_order_count", "repeat_order_count")
    assert got == [(20240304, 21, 1, D("2580.00"), 2580.0, 1, 0), (20240305, 22, 1, D("12600.00"), 12600.0, 1, 0),
                   (20240306, 23, 1, D("1005.00"), 1005.0, 1, 0)]


def test_review_and_payment_summaries(spark, shop, written, rows):
    assert rows(read(spark, shop, "gold", "gold_product_review_summary")) == [
        ("41", 20240310, 1, 5.0, 1, 0, 0, 1), ("42", 20240308, 1, 3.0, 0, 1, 0, 0), ("43", 20240312, 1, 4.0, 1, 0, 0, 0)]
    assert rows(read(spark, shop, "gold", "gold_payment_summary")) == [
        (20240304, "CARD", "SUCCESS", 1, 1, 0, D("2580.00"), 2580.0),
        (20240305, "WALLET", "FAILED", 1, 0, 1, D("12600.00"), 12600.0),
        (20240305, "WALLET", "SUCCESS", 1, 1, 0, D("12600.00"), 12600.0),
        (20240306, "CASH", "PENDING", 1, 0, 0, D("1005.00"), 1005.0)]


def test_reviews_keep_their_metadata(spark, shop, written):
    held = read(spark, shop, "silver", "fact_product_reviews").where("review_id = 'V-1'")
    row = held.selectExpr("to_json(metadata) as m", "review_length_chars", "review_date").first()
    assert json.loads(row["m"]) == samples.REVIEWS[0]["metadata"]
    assert (row["review_length_chars"], row["review_date"]) == (23, datetime(2024, 3, 10, 7, 45))


def test_review_keys_can_take_the_dimension_type(spark, rows):
    feed = spark.createDataFrame([("R1", "7", "x")], ["review_id", "product_id", "customer_id"])
    out = star.fact_product_reviews(feed, typed_keys=True)
    assert rows(out, "review_id", "product_id", "customer_id") == [("R1", 7, None)]
    assert star.fact_product_reviews(feed).first()["product_id"] == "7"


def test_absent_tables_leave_their_outputs_out(lazy, spark, shop):
    tables = layers.read_sources(spark, shop)
    silver, gold = layers.build_layers({"payment": tables["payment"]}, AS_OF, RUN)
    assert set(silver) == {"fact_payments"} and set(gold) == {"gold_payment_summary"}
    assert layers.build_layers({}, AS_OF, RUN) == ({}, {})


def test_absent_lookups_leave_typed_nulls(spark, shop, lazy):
    tables = {n: df for n, df in layers.read_sources(spark, shop).items() if n in ("product", "order_item", "customer", "product_variant")}
    silver, gold = layers.build_layers(tables, AS_OF, RUN)
    full, _ = lazy
    for name in ("dim_product", "dim_customer", "fact_order_items", "dim_product_variant"):
        assert silver[name].columns == full[name].columns, name
    assert silver["fact_order_items"].where("order_date_key is not null or customer_key is not null").count() == 0
    assert gold["gold_daily_sales_product"].count() == 3


def test_tables_of_nothing_but_keys_make_full_star_tables(spark, shop, lazy):
    full, _ = lazy
    tables = layers.read_sources(spark, shop)
    bare = {n: tables[n].select(*schemas.PRIMARY_KEYS[n]) for n in ("customer", "product", "product_variant", "orders", "order_item", "payment", "promotion")}
    silver, gold = layers.build_layers(bare | {n: tables[n] for n in ("brand", "category")}, AS_OF, RUN)
    for name, df in silver.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in full[name].schema], name
        assert name == "dim_date" or df.count() == full[name].count(), name
    assert {n: df.count() for n, df in gold.items()} == {
        "gold_daily_sales_product": 1, "gold_daily_sales_customer": 1, "gold_payment_summary": 1}


def test_repeated_lookup_keys_do_not_multiply_rows(spark, shop):
    tables = layers.read_sources(spark, shop)
    doubled = {n: tables[n].unionAll(tables[n]) for n in ("product", "brand", "category", "customer", "customer_address", "orders", "order_item")}
    silver, gold = layers.build_layers(tables | doubled, AS_OF, RUN)
    assert {n: silver[n].count() for n in ("dim_product", "dim_customer", "fact_orders", "fact_order_items")} == {
        "dim_product": 3, "dim_customer": 3, "fact_orders": 3, "fact_order_items": 4}
    assert gold["gold_daily_sales_product"].agg({"total_net_sales": "sum"}).first()[0] == D("16225.00")


def test_marts_group_by_what_exists(spark):
    items = spark.createDataFrame([(1, 2, D("3"))], "product_variant_key int, quantity int, gross_amount decimal(18,2)").selectExpr(
        "*", "gross_amount as discount_amount", "gross_amount as tax_amount", "gross_amount as shipping_amount",
        "gross_amount as net_line_amount", "1 as order_id", "'n' as product_name")
    assert marts.daily_sales_by_product(items).columns[:3] == ["product_variant_key", "product_name", "total_quantity_sold"]
    orders = spark.createDataFrame([(1, D("2"), None), (1, D("4"), True), (2, None, False)],
                                   "order_id int, grand_total_amount decimal(12,2), is_first_order boolean")
    for unique, count in ((False, 2), (True, 3)):
        out = marts.daily_sales_by_customer(orders, unique_orders=unique).first()
        assert (out["order_count"], out["avg_order_value"], out["first_order_count"], out["repeat_order_count"]) == (count, 3.0, 1, 1)


def test_mart_attributes_are_looked_up_after_the_totals(spark, lazy):
    silver, _ = lazy
    df = marts.daily_sales_by_product(silver["fact_order_items"], silver["dim_product_variant"])
    shown = df._jdf.queryExecution().optimizedPlan().toString()
    assert shown.index("Join LeftOuter") < shown.index("count(distinct order_id")


@pytest.mark.parametrize("partitions", ["1", "16"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_results_do_not_depend_on_settings(spark, shop, lazy, conf, rows, partitions, ansi):
    want = {n: rows(df) for n, df in lazy[1].items()}
    conf(spark__sql__shuffle__partitions=partitions, spark__sql__ansi__enabled=ansi)
    _, gold = layers.build_layers(layers.read_sources(spark, shop), AS_OF, RUN, ["NULL"], max_group_rows=1)
    assert {n: rows(df) for n, df in gold.items()} == want


def test_run_does_not_follow_the_session_zone(spark, shop, written, conf, rows, tmp_path):
    want = {n: rows(read(spark, shop, "gold", n)) for n in written if n.startswith("gold_")}

    def gold(name, **args):
        sinks = {layer: {"base_path": str(tmp_path / name / layer)} for layer in ("silver", "gold")}
        layers.run(spark, shop | sinks, AS_OF, RUN, null_tokens=["NULL"], **args)
        return {n: rows(read(spark, sinks, "gold", n)) for n in want}

    conf(spark__sql__session__timeZone="America/Los_Angeles")
    assert gold("west") == want
    assert spark.conf.get("spark.sql.session.timeZone") == "America/Los_Angeles"
    assert gold("east", zone="Pacific/Kiritimati") != want


@pytest.mark.parametrize("session", ["America/Los_Angeles", "Asia/Kolkata", "Pacific/Kiritimati"])
def test_layers_with_a_zone_do_not_follow_the_session(spark, shop, written, conf, rows, session):
    """Also where the session's zone changes after the frames were made."""
    def tables(layer):
        # instants are compared as numbers: as Python values they would follow the machine
        for n, df in layer.items():
            stamps = {f.name: F.unix_micros(f.name) for f in df.schema.fields if f.dataType.typeName() == "timestamp"}
            yield n, rows(df.drop("metadata", "ingestion_ts").withColumns({c: v for c, v in stamps.items() if c != "ingestion_ts"}))

    def built(zone):
        return layers.build_layers(layers.read_sources(spark, shop, zone), AS_OF, RUN, ["NULL"], zone=zone)

    want = [dict(tables(layer)) for layer in built(None)]  # the session is in UTC
    made_before = built("UTC")
    conf(spark__sql__session__timeZone=session)
    assert [dict(tables(layer)) for layer in made_before] == want
    assert [dict(tables(layer)) for layer in built("UTC")] == want
    assert [dict(tables(layer)) for layer in built(None)] != want


def test_a_run_that_fails_leaves_the_published_one(spark, shop, written, rows, tmp_path, monkeypatch):
    sinks = {layer: {"base_path": str(tmp_path / layer), "publish": True} for layer in ("silver", "gold")}
    with pytest.raises(ValueError, match="no published run"):
        writers.stored(spark, ["fact_orders"], sinks["silver"])
    assert layers.run(spark, shop | sinks, AS_OF, RUN, null_tokens=["NULL"]) == written

    def seen():
        return {n: rows(df.select(*[c for c in df.columns if c != "metadata"]))
                for layer in sinks for n, df in writers.stored(spark, of_layer[layer], sinks[layer]).items()}

    of_layer = {layer: [n for n in written if n.startswith("gold_") == (layer == "gold")] for layer in sinks}
    before = seen()
    marts_built = marts.build_marts

    def broken(*args, **kwargs):
        built = marts_built(*args, **kwargs)
        name = "gold_payment_summary"
        return built | {name: built[name].withColumn("payment_attempts", F.raise_error(F.lit("broken table")))}

    monkeypatch.setattr(marts, "build_marts", broken)
    later = datetime(2025, 12, 1)
    with pytest.raises(Exception, match="broken table"):
        layers.run(spark, shop | sinks, AS_OF, later, null_tokens=["NULL"])
    assert seen() == before  # silver of the failed run was written, but never put in force
    monkeypatch.undo()
    layers.run(spark, shop | sinks, AS_OF, later, null_tokens=["NULL"])
    assert seen() != before
    assert {n: len(r) for n, r in seen().items()} == written
    assert [published.discard(spark, sink) for sink in sinks.values()] == [2, 2]
    assert {n: len(r) for n, r in seen().items()} == written
    for wrong in ({"base_path": "x", "catalog_db": "d", "publish": True}, {"jdbc": {}, "publish": True}):
        with pytest.raises(ValueError, match="folder sink"):
            published.is_published(wrong)


def test_command_line(spark, shop, written, tmp_path, capsys):
    sinks = {layer: {"base_path": str(tmp_path / layer)} for layer in ("silver", "gold")}
    config = tmp_path / "settings.json"
    config.write_text(json.dumps({"environments": {"dev": shop | sinks}}))
    rows = cli.main(["--config", str(config), "--as-of", "2025-11-30", "--null-token", "NULL", "--show-summary"])
    assert rows == written
    printed = capsys.readouterr().out
    assert "fact_orders: 3 rows" in printed and "|gold_payment_summary" in printed
    with pytest.raises(ValueError, match="prod"):
        cli.main(["--config", str(config), "--env", "prod"])


def test_run_checks_its_settings_first(spark, shop):
    with pytest.raises(ValueError, match="gold"):
        layers.run(spark, {k: v for k, v in shop.items() if k != "gold"}, AS_OF, RUN)
    with pytest.raises(ValueError, match="read back"):
        layers.run(spark, shop | {"silver": {"jdbc": {}}}, AS_OF, RUN)
    with pytest.raises(ValueError, match="relational"):
        layers.read_sources(spark, {"feeds": {}})


def test_no_python_runs_per_row(lazy):
    for tables in lazy:
        for name, df in tables.items():
            shown = df._jdf.queryExecution().executedPlan().toString()
            assert "EvalPython" not in shown and "InPandas" not in shown and "CartesianProduct" not in shown, name


def test_every_export_schema_has_its_keys():
    names = {n: readers.parse_schema(ddl).names for n, ddl in schemas.RELATIONAL.items()}
    assert set(schemas.PRIMARY_KEYS) == set(names) and len(names) == 28
    for table, keys in schemas.PRIMARY_KEYS.items():
        assert set(keys) <= set(names[table])
    for child, column, parent in schemas.REFERENCES:
        assert column in names[child] and parent in names
