"""Domain cleaning and enrichment rules on their edge cases."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retail_layers.functions import dates, numbers
from retail_layers.operators.derive import derive
from retail_layers.plans import clean, enrich

RUN = datetime(2025, 11, 30)
AS_OF = date(2025, 11, 30)


def column(df, name):
    return [r[name] for r in df.collect()]


def test_names_split_on_spaces_only(spark):
    df = spark.createDataFrame([("McDONALD", "o'neil-SMITH de la CRUZ"), (None, "")], ["first_name", "last_name"])
    assert [tuple(r) for r in clean.normalize_names(df).collect()] == [("Mcdonald", "O'neil-smith De La Cruz"), (None, "")]


def test_email_validity(spark):
    df = spark.createDataFrame([(" A.b+c@Ex-ample.CO ",), ("a@b.co\n",), ("a@b",), ("a b@c.de",), ("",), (None,)], "email string")
    out = clean.clean_email(df)
    assert column(out, "email")[0] == "a.b+c@ex-ample.co"
    assert column(out, "email_is_valid") == [True, False, False, False, False, None]


def test_phone_validity(spark):
    df = spark.createDataFrame([("+91 98\t76",), ("12-34-5",), ("call 123456",), ("",), (None,)], "phone_number string")
    out = clean.clean_phone(df)
    assert column(out, "phone_number") == ["+919876", "12-34-5", "call123456", "", None]
    assert column(out, "phone_is_valid") == [True, False, True, False, None]


def test_product_name_and_sku(spark):
    df = spark.createDataFrame([("  ", " A1 ")], ["product_name", "sku"])
    out = clean.trim_columns(clean.normalize_product_name(df), ["sku", "variant_name"])
    assert tuple(out.first()) == (None, "A1")


def test_total_mismatch_tolerates_one_cent(spark):
    def money(*values):
        return tuple(None if v is None else Decimal(v) for v in values)

    df = spark.createDataFrame(
        [money("10", "1", "2", "3", "14.00"), money("10", "1", "2", "3", "14.01"), money("10", "1", "2", "3", "14.02"),
         money("10", None, "2", "3", "14"), money("10", "1", "2", "3", None)],
        ", ".join(f"{c} decimal(12,2)" for c in clean.ORDER_TOTALS))
    assert column(clean.flag_total_mismatch(df), "amount_mismatch_flag") == [False, False, True, None, None]
    assert "amount_mismatch_flag" not in clean.flag_total_mismatch(df.drop("total_tax_amount")).columns


def test_rating_is_flagged_before_it_is_clipped(spark):
    df = spark.createDataFrame([("0",), ("4.7",), ("6",), ("good",), (None,)], "rating string")
    out = clean.clean_rating(df)
    assert column(out, "rating") == [1, 4, 5, None, None]
    assert column(out, "rating_was_out_of_range") == [True, False, True, None, None]


def test_review_text_is_cut_by_characters(spark):
    df = spark.createDataFrame([("é" * 4999,), (" " + "é" * 5000 + " ",), ("é" * 5001,), (None,)], "review_text string")
    out = clean.limit_text(df)
    assert [None if v is None else len(v) for v in column(out, "review_text")] == [4999, 5000, 5000, None]
    assert column(out, "review_text_was_truncated") == [False, False, True, None]
    whole = clean.limit_text(df, max_length=None)
    assert [None if v is None else len(v) for v in column(whole, "review_text")] == [4999, 5000, 5001, None]
    assert column(whole, "review_text_was_truncated") == [False, False, False, None]
    reviews = df.selectExpr("concat('r', coalesce(length(review_text), 0)) as review_id", "review_text")
    for limit, longest in ((None, 5001), (7, 7)):
        cut = clean.clean_table("product_reviews", reviews, RUN, max_review_chars=limit)
        assert max(len(v) for v in column(cut, "review_text") if v) == longest


def test_bands_at_their_edges(spark):
    ages = spark.createDataFrame([(a,) for a in (17, 18, 25, 26, 35, 36, 45, 46, None)], "age_years bigint")
    got = column(ages.select(numbers.band(F.col("age_years"), enrich.AGE_BANDS, enrich.AGE_TOP).alias("b")), "b")
    assert got == ["UNDER_18", "18_25", "18_25", "26_35", "26_35", "36_45", "36_45", "46_PLUS", "UNKNOWN"]
    totals = spark.createDataFrame([(Decimal(v),) for v in ("1999.99", "2000", "10000", "10000.01")], "grand_total_amount decimal(12,2)")
    assert column(derive(totals, *enrich.order_rules()), "order_value_band") == ["LOW", "MEDIUM", "MEDIUM", "HIGH"]


def test_age_is_whole_years(spark):
    df = spark.createDataFrame([(date(1990, 5, 15),), (date(2007, 11, 30),), (None,)], "date_of_birth date")
    out = derive(df, *enrich.customer_rules(AS_OF))
    assert out.schema["age_years"].dataType.simpleString() == "bigint"
    assert column(out, "age_years") == [35, 18, None]
    assert column(out, "age_band") == ["26_35", "18_25", "UNKNOWN"]


def test_full_name_skips_missing_parts(spark):
    df = spark.createDataFrame([("A", None), (None, None)], "first_name string, last_name string")
    assert column(derive(df, *enrich.customer_rules(AS_OF)), "full_name") == ["A", ""]


def test_metro_and_address_text(spark):
    df = spark.createDataFrame([(" mumbai ", "MH"), ("Nagpur", None), (None, "x ")], "city string, state string")
    out = derive(df, *enrich.address_rules())
    assert column(out, "is_metro_city") == [True, False, None]
    assert column(out, "state_normalized") == ["MH", None, "X"]


def test_variant_key_skips_a_missing_sku(spark):
    df = spark.createDataFrame([(1, " a "), (2, None)], "product_id int, sku string")
    out = derive(df, *enrich.variant_rules())
    assert column(out, "variant_key") == ["1| a ", "2"]
    assert column(out, "sku_normalized") == ["A", None]


def test_stock_flags(spark):
    df = spark.createDataFrame([(10, 10), (5, 9), (11, 1), (12, 1), (None, 1)], "on_hand_qty int, reserved_qty int")
    out = derive(df, *enrich.stock_rules())
    assert column(out, "available_qty") == [0, -4, 10, 11, None]
    assert column(out, "is_out_of_stock") == [True, True, False, False, None]
    assert column(out, "is_low_stock") == [False, False, True, False, None]


def test_line_amounts(spark):
    df = spark.createDataFrame(
        [(2, Decimal("500"), Decimal("100"), Decimal("180"), Decimal("50")), (0, Decimal("5"), Decimal("1"), None, Decimal("1")),
         (None, Decimal("5"), Decimal("1"), Decimal("1"), Decimal("1"))],
        "quantity int, base_unit_price decimal(12,2), discount_amount decimal(12,2), tax_amount decimal(12,2), shipping_amount decimal(12,2)")
    out = derive(df, *enrich.line_rules())
    assert column(out, "gross_amount") == [Decimal("1000.00"), Decimal("0.00"), None]
    assert column(out, "effective_discount_pct") == [10.0, 0.0, 0.0]
    assert column(out, "net_line_amount") == [Decimal("1130.00"), None, None]


def test_payment_and_review_flags(spark):
    pay = spark.createDataFrame([("SUCCESS",), ("FAILED",), (None,)], "payment_status_code string")
    assert [tuple(r)[1:] for r in derive(pay, *enrich.payment_rules()).collect()] == [(True, False), (False, True), (None, None)]
    review = spark.createDataFrame([(5, 5, "abc"), (3, 4, ""), (2, None, None), (None, 0, "x")], "rating int, helpful_votes int, review_text string")
    out = derive(review, *enrich.review_rules())
    assert column(out, "review_sentiment_label") == ["GOOD", "NEUTRAL", "BAD", "UNKNOWN"]
    assert column(out, "is_helpful_review") == [True, False, None, False]
    assert column(out, "review_length_chars") == [3, 0, None, 1]


@pytest.mark.parametrize("flag_type", ["int", "boolean"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_validity_interval(spark, conf, flag_type, ansi):
    conf(spark__sql__ansi__enabled=ansi)
    day = datetime(2025, 11, 30, 23, 0)
    df = spark.createDataFrame(
        [(day, day, 1), (day, None, 1), (datetime(2025, 12, 1), None, 1), (day, datetime(2025, 11, 29), 1), (day, None, 0),
         (None, None, 1), (day, None, None)],
        "start_date timestamp, end_date timestamp, is_active int").withColumn("is_active", F.col("is_active").cast(flag_type))
    got = column(derive(df, *enrich.promotion_rules(AS_OF)), "is_currently_active")
    assert got == [True, True, False, False, False, None, None]


def test_order_date_parts_and_key(spark):
    df = spark.createDataFrame([(datetime(2024, 12, 30, 23, 59),), (None,)], "order_date timestamp")
    out = derive(df, *enrich.order_rules()).withColumn("key", dates.date_key(F.col("order_date")))
    assert tuple(out.first())[1:] == (date(2024, 12, 30), 2024, 12, 30, 1, 20241230)
    assert column(out, "key")[1] is None


def test_unknown_tables_are_cleaned_generically_and_pass_enrichment(spark):
    df = spark.createDataFrame([(" a ", 1), (" a ", 1)], ["code", "n"])
    tidy = clean.clean_tables({"carrier": df}, RUN)["carrier"]
    assert tidy.count() == 2 and column(tidy, "code") == ["a", "a"]
    assert enrich.enrich_tables({"carrier": tidy}, AS_OF)["carrier"] is tidy


def test_cleaners_tolerate_absent_columns(spark):
    for name, rules in clean.RULES.items():
        only_keys = spark.createDataFrame([tuple("1" for _ in rules.keys)], list(rules.keys))
        out = clean.clean_table(name, only_keys, RUN)
        assert out.count() == 1, name
        assert enrich.enrich_table(name, out, AS_OF).count() == 1, name


def test_cleaners_drop_missing_keys_and_keep_one_row_per_key(spark, rows):
    df = spark.createDataFrame([(1, " b "), (1, "a"), (None, "c"), (2, "")], "product_id int, product_name string")
    for rare in (False, True):
        out = clean.clean_table("product", df, RUN, rare_duplicates=rare)
        assert rows(out, "product_id", "product_name") == [(1, "a"), (2, None)]


def test_attributes_keep_rows_without_a_start(spark, rows):
    df = spark.sql("""select * from values ('1', '2025-10-01T00:00:00Z', '{"a":2}'), ('1', '2025-10-01T00:00:00Z', '{"a":1}'),
                      ('1', 'soon', '{}'), (null, '2025-10-01T00:00:00Z', '{}') t(product_id, effective_from, a)
                   """).selectExpr("product_id", "effective_from", "parse_json(a) as attributes")
    out = clean.clean_table("product_attributes", df, RUN)
    got = rows(out.select("product_id", "effective_from", F.to_json("attributes")))
    assert got == [("1", None, "{}"), ("1", datetime(2025, 10, 1), '{"a":1}')]
